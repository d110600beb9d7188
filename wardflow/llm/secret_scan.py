"""Secret scans: fixed patterns, and a battery of randomness tests under false-discovery control.

Runs of ``[A-Za-z0-9+/_=-]`` are cut at every ``=`` inside them; a part that holds symbols of both
base64 alphabets, so that no alphabet holds all of it, is cut into its maximal pieces of each
alphabet, which may overlap. Every piece of 20 or more characters that is not all digits and does
not touch a pattern match is a candidate. Its encoding is the smallest of hex, base32, lower case,
letters and digits, and base64 alphabets that holds it, without padding. The battery then asks
whether the symbols could be drawn at random from that alphabet:

* chi-squared uniformity over bins of equal width, as many as the length can fill;
* Wald-Wolfowitz runs about the middle of the alphabet;
* lag-1 serial correlation.

A candidate that fails (Bonferroni-combined p below ``consistent``) is not random. For the others
the evidence against ordinary text is an exact binomial tail: symbols are ranked by how often they
occur in the runs of all documents, and a random string holds far too many of the rarer half for
ordinary text. The tail depends on the length, and candidates are grouped by length as well:
Benjamini-Hochberg keeps the false-discovery rate of each group at ``rate``. The thresholds come
from counts of all candidates of all documents by group and binned p.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm import textscan
from wardflow.llm.common import only, ship_code, slices, text_buffers

#: The base patterns, in the order of the contract (fixed values).
KINDS = ["assign", "access", "hex", "random"]
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
PART = re.compile(r"[^=]+")
#: What a part that no alphabet holds is cut into.
PIECES = [re.compile(r"[A-Za-z0-9+/]+"), re.compile(r"[A-Za-z0-9_-]+"), re.compile(r"[A-Za-z0-9]+")]
KEYWORDS = (b"passw", b"secret", b"token", b"api")

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Alphabets from small to large; the first that holds all symbols of a run is its encoding.
ALPHABETS = [("hex", DIGITS + LOWER[:6]), ("HEX", DIGITS + UPPER[:6]), ("lower", LOWER),
             ("base32", UPPER + DIGITS[2:8]), ("lower36", LOWER + DIGITS),
             ("upper36", UPPER + DIGITS), ("letters", LOWER + UPPER),
             ("alnum", DIGITS + LOWER + UPPER), ("base64", UPPER + LOWER + DIGITS + "+/"),
             ("base64url", UPPER + LOWER + DIGITS + "-_")]
#: Lower ends of the length groups for the false-discovery control.
GROUPS = (20, 28, 40, 64, 128)
#: p values are binned by the hundredth of their decimal logarithm, up to 1e-30.
PER_DECADE, DECADES = 100, 30


@dataclass(frozen=True)
class SecretParams:
    min_run: int = 20
    min_assign: int = 6
    min_access: int = 20
    min_hex: int = 24
    consistent: float = 1e-3
    rate: float = 1e-3


def base_spans(text: str, params: SecretParams) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns, ordered; spans are whole matches."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
           if len(m.group(2)) >= params.min_assign]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)
            if m.end() - m.start() >= params.min_access]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)
            if m.end() - m.start() >= params.min_hex]
    return sorted(out)


def normal_tail(z: float) -> float:
    """Two-sided p of a standard normal value."""
    return math.erfc(abs(z) / math.sqrt(2))


def chi_squared_tail(x: float, df: int) -> float:
    """Upper tail by the Wilson-Hilferty cube root."""
    if x <= 0:
        return 1.0
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


def binomial_tail(n: int, k: int, p: float) -> float:
    """P(X >= k) for n draws at probability p."""
    if k <= 0:
        return 1.0
    if p <= 0:
        return 0.0
    if p >= 1:
        return 1.0
    first = (math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
             + k * math.log(p) + (n - k) * math.log1p(-p))
    term, total = 1.0, 1.0
    for i in range(k, n):
        term *= (n - i) / (i + 1) * p / (1 - p)
        total += term
        if term < total * 1e-12:
            break
    return min(1.0, math.exp(min(0.0, first + math.log(total))))


def infer_encoding(run: str) -> tuple[str, str] | None:
    """Name and alphabet, None for runs of one symbol class that no encoding uses."""
    symbols = set(run)
    return next((a for a in ALPHABETS if symbols <= set(a[1])), None)


def pieces(run: str) -> list[tuple[int, int]]:
    """Begin and end of the pieces of a run that an alphabet holds; padding goes with the last."""
    body, out = run.rstrip("="), set()
    for part in PART.finditer(body):
        cuts = [part] if infer_encoding(part.group()) else [
            piece for kind in PIECES for piece in kind.finditer(body, *part.span())]
        out |= {(c.start(), len(run) if c.end() == len(body) else c.end()) for c in cuts}
    return sorted(out)


def battery(run: str, alphabet: str) -> float:
    """Bonferroni-combined p that the run is uniform and independent over the alphabet."""
    k, n = len(alphabet), len(run)
    place = {c: i for i, c in enumerate(alphabet)}
    x = np.array([place[c] for c in run], np.float64)
    bins = max(2, min(k, n // 5))
    seen = np.bincount((x * bins // k).astype(np.int64), minlength=bins)
    # Bins differ by one symbol when the alphabet does not divide evenly.
    share = np.bincount((np.arange(k) * bins // k), minlength=bins) / k
    uniform = chi_squared_tail(float((((seen - n * share) ** 2) / (n * share)).sum()), bins - 1)
    high = x >= k / 2
    ones = int(high.sum())
    if 0 < ones < n:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 1 + 2 * ones * (n - ones) / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        runs_p = normal_tail((runs - mean) / math.sqrt(var)) if var > 0 else 1.0
    else:
        runs_p = 0.0 if n > 10 else 1.0
    c = x - x.mean()
    power = float((c * c).sum())
    serial_p = normal_tail(float((c[1:] * c[:-1]).sum()) / power * math.sqrt(n)) if power else 0.0
    return min(1.0, 3 * min(uniform, runs_p, serial_p))


def rare_half(alphabet: str, weight: dict[str, float]) -> tuple[set[str], float]:
    """The half of the alphabet that ordinary runs use least, and its share of their symbols."""
    ranked = sorted(alphabet, key=lambda c: (weight.get(c, 0.0), c))
    rare = set(ranked[:len(alphabet) // 2])
    total = sum(weight.get(c, 0.0) + 1.0 for c in alphabet)
    return rare, sum(weight.get(c, 0.0) + 1.0 for c in rare) / total


class Battery:
    """The battery with the symbol counts of ordinary runs."""

    def __init__(self, weight: dict[str, float], params: SecretParams):
        self.params = params
        self.alphabets = {name: rare_half(letters, weight) for name, letters in ALPHABETS}

    def judge(self, run: str) -> tuple[str, float, int] | None:
        """Encoding, battery p, and bin of the evidence against text; None if not a candidate."""
        body = run.rstrip("=")
        if len(body) < self.params.min_run or body.isdigit():
            return None
        found = infer_encoding(body)
        if found is None:
            return None
        name, alphabet = found
        rare, share = self.alphabets[name]
        p = binomial_tail(len(body), sum(c in rare for c in body), share)
        level = DECADES * PER_DECADE if p <= 10.0 ** -DECADES else int(
            -math.log10(p) * PER_DECADE)
        return name, battery(body, alphabet), max(0, level)


def _runs(data: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of byte runs over the run alphabet with at least ``least`` bytes."""
    table = np.zeros(256, np.uint8)
    table[[ord(c) for c in DIGITS + LOWER + UPPER + "+/_=-"]] = 1
    words = textscan.scan(data, offsets, table)
    long = words.end - words.start >= least
    return words.start[long], words.end[long]


def _symbol_batches(batches):
    """How often each byte of the run alphabet occurs; one row per symbol and batch."""
    total = np.zeros(256, np.int64)
    for batch in batches:
        data, _ = text_buffers(batch.column(0))
        total += np.bincount(data, minlength=256)
    letters = DIGITS + LOWER + UPPER + "+/_-"
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(letters)), pa.array([int(total[ord(c)]) for c in letters])],
        ["symbol", "n"])


def _places(data: bytes, needle: bytes) -> list[int]:
    out, at = [], data.find(needle)
    while at >= 0:
        out.append(at)
        at = data.find(needle, at + 1)
    return out


def _level_of(size: int) -> int:
    return sum(size >= least for least in GROUPS[1:])


class Scanner:
    """Base spans and candidates of the documents of a run of bytes."""

    def __init__(self, weight: dict[str, float], params: SecretParams):
        self.params, self.battery = params, Battery(weight, params)

    def one(self, text: str) -> tuple[list[tuple], list[tuple]]:
        """Base spans (start, kind, end), candidates (start, 3, end, group, level, p, encoding)."""
        spans = base_spans(text, self.params)
        candidates = []
        for m in RUN.finditer(text):
            if m.end() - m.start() < self.params.min_run:
                continue
            for a, b in pieces(m.group()):
                start, end = m.start() + a, m.start() + b
                if end - start < self.params.min_run \
                        or any(s < end and start < e for s, _, e in spans):
                    continue
                found = self.battery.judge(text[start:end])
                if found:
                    size = len(text[start:end].rstrip("="))
                    candidates.append(
                        (start, 3, end, _level_of(size), found[2], found[1], found[0]))
        return spans, candidates

    def touched(self, data: np.ndarray, offsets: np.ndarray):
        """The documents that hold a keyword, a key prefix or a long run, with their texts."""
        raw = data.tobytes()
        low = raw.lower()  # ASCII letters only
        marks = [p for k in KEYWORDS for p in _places(low, k)] + _places(raw, b"AKIA")
        begin, _ = _runs(data, offsets, min(self.params.min_run, self.params.min_hex))
        at = np.concatenate([np.array(marks, np.int64), begin])
        for d in np.unique(np.searchsorted(offsets, at, side="right") - 1):
            yield int(d), raw[offsets[d]:offsets[d + 1]].decode("utf-8")

    def random_spans(self, candidates: list[tuple], limit: dict[int, int]) -> list[tuple]:
        """The candidates that are discoveries, but for those inside another one."""
        found = [c for c in candidates if c[5] >= self.params.consistent
                 and c[4] >= limit.get(c[3], DECADES * PER_DECADE + 1)]
        out, upto = [], 0
        for c in sorted(found, key=lambda c: (c[0], -c[2])):
            if c[2] > upto:
                out.append(c)
                upto = c[2]
        return out


def _said(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[s[1]]}:{s[0]}:{s[2]}" for s in spans)


def _count_batches(weight: dict[str, float], params: SecretParams):
    """Candidates by length group and evidence bin, of one task."""
    def run(batches):
        scanner, seen = Scanner(weight, params), {}
        for batch in batches:
            data, offsets = text_buffers(batch.column(0))
            for a, b in slices(offsets):
                for _, text in scanner.touched(data[offsets[a]:offsets[b]],
                                               offsets[a:b + 1] - offsets[a]):
                    for c in scanner.one(text)[1]:
                        seen[c[3], c[4]] = seen.get((c[3], c[4]), 0) + 1
        keys = sorted(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([seen[k] for k in keys], pa.int64())], ["g", "level", "n"])
    return run


def thresholds(counts: list[tuple[int, int, int]], rate: float) -> dict[int, int]:
    """Benjamini-Hochberg per length group: the lowest evidence bin that is still a discovery.

    ``counts`` holds (group, bin, candidates). A bin stands for its largest p, so binning only
    makes the control stricter.
    """
    out = {}
    for group in {g for g, _, _ in counts}:
        mine = sorted(((level, n) for g, level, n in counts if g == group), reverse=True)
        total, above, best = sum(n for _, n in mine), 0, DECADES * PER_DECADE + 1
        for level, n in mine:
            above += n
            if 10.0 ** (-level / PER_DECADE) * total <= rate * above:
                best = level
        out[group] = best
    return out


_FOUND = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32()),
                             ("encoding", pa.string())]))


def _find_batches(weight, limit, params: SecretParams):
    def run(batches):
        scanner = Scanner(weight, params)
        for batch in batches:
            ids = batch.column(0)
            data, offsets = text_buffers(batch.column(1))
            for a, b in slices(offsets):
                base, every = [[] for _ in range(b - a)], [[] for _ in range(b - a)]
                for d, text in scanner.touched(data[offsets[a]:offsets[b]],
                                               offsets[a:b + 1] - offsets[a]):
                    base[d], candidates = scanner.one(text)
                    every[d] = sorted(base[d] + scanner.random_spans(candidates, limit))
                numbers = [pa.array([sum(s[1] == k for s in e) for e in every], pa.int64())
                           for k in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), *numbers,
                     pa.array([hashlib.sha256(_said(s).encode()).hexdigest() for s in base]),
                     pa.array([_said(s) for s in every], pa.string()),
                     pa.array([[{"start": s[0], "kind": KINDS[s[1]], "end": s[2],
                                 "encoding": s[6] if len(s) > 3 else None} for s in e]
                               for e in every], _FOUND)],
                    ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "found"])
    return run


def mask(text: str, spans: list[tuple]) -> str:
    """``text`` with every span replaced by ``[kind]``; spans that overlap become the first."""
    out, upto = [], 0
    for s in spans:
        if s[0] >= upto:
            out += [text[upto:s[0]], "[", KINDS[s[1]], "]"]
        upto = max(upto, s[2])
    return "".join([*out, text[upto:]])


def _mask_batches(weight, limit, params: SecretParams, columns: list[str]):
    def run(batches):
        scanner, at = Scanner(weight, params), columns.index("text")
        for batch in batches:
            data, offsets = text_buffers(batch.column(at))
            for a, b in slices(offsets):
                part, changed = batch.slice(a, b - a), {}
                for d, text in scanner.touched(data[offsets[a]:offsets[b]],
                                               offsets[a:b + 1] - offsets[a]):
                    base, candidates = scanner.one(text)
                    spans = sorted(base + scanner.random_spans(candidates, limit))
                    if spans:
                        changed[d] = mask(text, spans)
                arrays = list(part.columns)
                if changed:
                    texts = part.column(at).to_pylist()
                    for d, text in changed.items():
                        texts[d] = text
                    arrays[at] = pa.array(texts, part.schema.field(at).type)
                    if "n_chars" in columns:
                        place = columns.index("n_chars")
                        sizes = part.column(place).to_pylist()
                        for d, text in changed.items():
                            sizes[d] = len(text)
                        arrays[place] = pa.array(sizes, part.schema.field(place).type)
                yield pa.RecordBatch.from_arrays(arrays, schema=part.schema)
    return run


def _learned(docs: DataFrame, params: SecretParams) -> tuple[dict[str, float], dict[int, int]]:
    """Symbol counts and thresholds from all documents; each is a small fixed table."""
    texts = docs.select(F.col("text").cast("string").alias("text"))
    weight = {r["symbol"]: float(r["n"]) for r in texts.mapInArrow(
        _symbol_batches, "symbol string, n long").groupBy("symbol").agg(
        F.sum("n").alias("n")).collect()}
    counts = texts.mapInArrow(_count_batches(weight, params), "g int, level int, n long") \
        .groupBy("g", "level").agg(F.sum("n").alias("n")).collect()
    return weight, thresholds([tuple(r) for r in counts], params.rate)


def find_secrets(docs: DataFrame, params: SecretParams = SecretParams()) -> DataFrame:
    """All secrets of every row of ``docs(doc_id, text)``.

    Returns ``doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans`` and ``found``, the
    spans as an array of (start, kind, end, encoding). Positions are code points, ends exclusive;
    a span is a whole pattern match, or a whole random run or piece of one. Of two random pieces
    one of which holds the other, the larger is reported.

    Null or empty text: nothing found. Null doc_id: returned as such. Repeated rows: returned
    each, and each counts in the false-discovery control. An empty table gives an empty result;
    extra columns are ignored. A random piece that touches a pattern match is not reported again.
    """
    ship_code(docs.sparkSession)
    docs = only(docs, doc_id="long", text="string")
    weight, limit = _learned(docs, params)
    numbers = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.mapInArrow(
        _find_batches(weight, limit, params),
        f"doc_id long, {numbers}, base_sha256 string, spans string, "
        "found array<struct<start int, kind string, end int, encoding string>>")


def mask_secrets(docs: DataFrame, params: SecretParams = SecretParams()) -> DataFrame:
    """``docs`` with every secret of its ``text`` replaced by the secret's kind in brackets.

    All other columns stay as they are, except that ``n_chars``, where there is one, becomes the
    new length of a changed text. Null and empty texts, repeated rows, extra columns and empty
    tables pass through.
    """
    ship_code(docs.sparkSession)
    weight, limit = _learned(docs, params)
    return docs.mapInArrow(_mask_batches(weight, limit, params, docs.columns), docs.schema)
