"""Plain-Python versions of the operators, and small tables with every awkward case."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0d]+")

#: A document table whose extra columns clash with names that the operators use inside.
CLASHING = ["n", "h1", "slot", "key", "rep", "gram", "hash", "value", "part", "stack", "component",
            "bands", "lp", "n_bytes", "score", "entry", "_place", "found", "gone"]


def awkward_texts() -> list[tuple]:
    """(doc_id, text): nulls, empty, white space, repeated rows, a long text, near copies."""
    prose = " ".join(f"word{i} goes{i % 7} on{i % 11}." for i in range(60))
    return [
        (1, prose), (1, prose), (2, prose + " end"), (3, None), (4, ""), (5, " \n\t "),
        (None, prose), (None, None), (6, "one"), (6, "two other words"), (7, "é" * 10 + " ü\x00z"),
        (8, "long " * 60_000), (9, "x" * 40_000), (10, "\n".join(["same line here"] * 30)),
        (-11, prose.upper()),
    ]


def documents(spark, rows=None, clashing=True):
    """A documents table from (doc_id, text) pairs."""
    rows = awkward_texts() if rows is None else rows
    extra = CLASHING if clashing else []
    return spark.createDataFrame(
        [(i, t, "en", "s", len(t or ""), *["?"] * len(extra)) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long"
        + "".join(f", `{c}` string" for c in extra))


def empty_documents(spark):
    return documents(spark, [])


def fold(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(words: list, size: int) -> list[tuple]:
    size = min(size, len(words))
    return [tuple(words[i:i + size]) for i in range(len(words) - size + 1)] if words else []


def near_duplicates(rows: list[tuple], size: int, percent: int = 80) -> dict:
    """doc_id -> smallest doc_id reachable; texts of one id count as one node."""
    sets = [(i, frozenset(shingles(WORD.findall(fold(t or "")), size))) for i, t in rows
            if i is not None]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return {i: root(i) for i in parent}


def base_quality(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    many = Counter(windows)
    covered = {j for i, w in enumerate(windows) if many[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n)


def kneser_ney(sequences: list[list[int]], order: int, size: int, pad: int):
    """Modified Kneser-Ney by dictionaries: a function (context, symbol) -> log probability."""
    top = Counter()
    for s in sequences:
        padded = [pad] * (order - 1) + s
        for i in range(len(s)):
            top[tuple(padded[i:i + order])] += 1
    counts = {order: top}
    for n in range(order - 1, 0, -1):
        below = Counter()
        for gram in counts[n + 1]:
            below[gram[1:]] += 1
        counts[n] = below
    total1 = sum(counts[1].values())
    p1 = {s: 0.01 / size + 0.99 * counts[1].get((s,), 0) / total1 for s in range(size)}
    discounts, totals, weights = {}, {}, {}
    for n in range(2, order + 1):
        c = Counter(counts[n].values())
        n1, n2, n3, n4 = (c.get(i, 0) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        d = [1 - 2 * y * n2 / n1 if n1 and n2 else 0.5, 2 - 3 * y * n3 / n2 if n2 and n3 else 1.0,
             3 - 4 * y * n4 / n3 if n3 and n4 else 1.5]
        discounts[n] = [0.0] + [min(max(x, 0.05), i + 0.95) for i, x in enumerate(d)]
        totals[n], weights[n] = defaultdict(float), defaultdict(float)
        for gram, k in counts[n].items():
            totals[n][gram[:-1]] += k
            weights[n][gram[:-1]] += discounts[n][min(k, 3)]

    def p(context: tuple, symbol: int) -> float:
        n = len(context) + 1
        if n == 1:
            return p1[symbol]
        lower = p(context[1:], symbol)
        if context not in totals[n]:
            return lower
        k = counts[n].get((*context, symbol), 0)
        return ((k - discounts[n][min(k, 3)]) + weights[n][context] * lower) / totals[n][context]

    return lambda context, symbol: math.log(p(tuple(context), symbol))


def leak_words(text: str | None) -> list[bytes]:
    return [w.lower() for w in re.findall(rb"[A-Za-z0-9\x80-\xff]+", (text or "").encode())]


def leaks(docs: list[tuple], items: list[tuple], percent: int = 80) -> dict:
    """(doc_id, item_id) -> best weighted Jaccard over item-sized windows."""
    out = {}
    for d, text in docs:
        words = leak_words(text)
        seen = {k: set(shingles(words, k)) for k in range(1, 6)}
        for i, passage in items:
            own = leak_words(passage)
            if d is None or i is None or not own or not words:
                continue
            size = min(5, len(own))
            size = min(size, len(words)) if len(words) < len(own) else size
            want = Counter(shingles(own, min(5, len(own))))
            if not want.keys() & seen[size]:
                continue  # nothing in common anywhere
            for a in range(max(1, len(words) - len(own) + 1)):
                have = Counter(shingles(words[a:a + len(own)], size))
                both, whole = sum((want & have).values()), sum((want | have).values())
                if 100 * both >= percent * whole:
                    out[d, i] = max(out.get((d, i), 0), both / whole)
    return out


def secret_spans(text: str | None) -> list[tuple]:
    text, out = text or "", []
    rule = (r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"""
            r"""[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?"""
            r"""([A-Za-z0-9+/_.=-]+)""")
    out += [(m.start(), 0, m.end()) for m in re.finditer(rule, text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)
            if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def pii_spans(text: str | None) -> list[tuple]:
    text, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in
            re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in
            re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        doubled = [d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
                   for i, d in enumerate(reversed(digits))]
        if 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def judge_url(url: str | None, rules: list[tuple], default: str) -> tuple:
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = fold(host)
    fit = [(len(h) + len(p), len(h), h, p, v) for v, h, p in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit) if fit else None
    return (host, path, best[2] + best[3] if best else None, best[4] if best else default)
