"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Candidates are the base pattern matches, which always stay, and matches of wider patterns: phone
numbers without a plus sign, national numbers, bank accounts, long digit groups that fail the card
checksum, and names after a title. Four labelers vote on each candidate for (+1), against (-1) or
not at all (0): a strict pattern with checksums, a gazetteer, the words around it, and its layout.

Expectation-maximisation over the counts of (kind, votes) in all documents estimates how often
each labeler is right when it votes, and how frequent personal data are among the candidates of a
kind. The posterior of each count then trains a logistic span classifier on the kind, the votes
and the shape of a span; its verdict adds spans to the base ones. Only counts of fixed patterns
reach the driver, however many documents there are.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm import textscan
from wardflow.llm.common import only, ship_code, slices, text_buffers

#: Base kinds in the order of the contract, then those that the method adds (fixed values).
BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "phone_local", "national_id", "iban", "account", "name"]

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
DIGIT_CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
PHONE_LOCAL = re.compile(
    r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
NATIONAL_ID = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}"
                  r"(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
NAME = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Madame|Monsieur|Señor|Señora)\.?\x20"
                  r"[A-ZÀ-Þ][a-zß-ÿ]+(?:\x20[A-ZÀ-Þ][a-zß-ÿ]+)?")
TITLES = (b"Mr", b"Ms", b"Dr", b"Prof", b"Herr", b"Frau", b"Madame", b"Monsieur", b"Se\xc3\xb1or")

#: Gazetteers and cue words (fixed values).
TOP_LEVEL = frozenset("com org net edu gov int info io eu us uk de fr es it nl ch at be".split())
GIVEN_NAMES = frozenset(
    "james john robert michael david william richard thomas mary patricia jennifer linda "
    "elizabeth barbara susan sarah hans peter klaus anna maria jean pierre marie louis jose juan "
    "carlos carmen".split())
COUNTRY_CODES = ("1", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44",
                 "45", "46", "47", "48", "49", "51", "52", "54", "55", "61", "81", "82", "86", "90",
                 "91")
IBAN_COUNTRIES = frozenset("AT BE CH DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split())
CARD_STARTS = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "65", "35", "36", "38")
CUES_FOR = frozenset(
    "phone tel telephone call mobile fax contact mail email e-mail write card visa mastercard "
    "credit account iban bank ssn social security ip address host name telefon anruf konto karte "
    "téléphone carte compte teléfono tarjeta cuenta".split())
CUES_AGAINST = frozenset(
    "order invoice isbn issn version ticket serial item page ref chapter doi build sku "
    "bestellung rechnung facture commande pedido factura".split())

LABELERS = 4


@dataclass(frozen=True)
class PiiParams:
    rounds: int = 200
    threshold: float = 0.5
    start_accuracy: float = 0.8


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    raw = text.replace(" ", "")
    moved = raw[4:] + raw[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping mail addresses, found from the at signs in linear time.

    A match of the base pattern at an at sign begins where the run of local characters before it
    begins, or where the match before it ended.
    """
    out, upto, at = [], 0, text.find("@")
    while at >= 0:
        found = DOMAIN.match(text, at)
        if found:
            start = at
            while start > upto and text[start - 1] in LOCAL_CHARS:
                start -= 1
            if start < at:
                out.append((start, found.end()))
                upto = found.end()
        at = text.find("@", max(at + 1, upto))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base patterns, ordered."""
    out = [(a, 0, b) for a, b in emails(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255
                   for p in m.group().split("."))]
    for m in DIGIT_CHAIN.finditer(text):
        digits = _digits(m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text)
            if 9 <= len(_digits(m.group())) <= 15]
    return sorted(out)


def wider_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates of the added kinds; of those that overlap each other or a base span, the first."""
    found = [(m.start(), kind, m.end()) for kind, rule in (
        (4, PHONE_LOCAL), (5, NATIONAL_ID), (6, IBAN), (8, NAME)) for m in rule.finditer(text)]
    for m in DIGIT_CHAIN.finditer(text):
        if 12 <= len(_digits(m.group())) <= 19:
            found.append((m.start(), 7, m.end()))
    taken, out = sorted((a, b) for a, _, b in base), []
    i, upto = 0, 0
    for span in sorted(found):
        while i < len(taken) and taken[i][1] <= span[0]:
            i += 1
        if span[0] >= upto and not (i < len(taken) and taken[i][0] < span[2]):
            out.append(span)
            upto = span[2]
    return out


def votes(text: str, span: tuple[int, int, int]) -> tuple[int, int, int, int]:
    """The four labelers' votes on a candidate: strict pattern, gazetteer, context, layout."""
    start, kind, end = span
    said = text[start:end]
    digits = _digits(said)
    strict = gazetteer = layout = 0
    if kind == 0:
        strict = 1 if not said.startswith(".") and ".." not in said else -1
        gazetteer = 1 if said.rsplit(".", 1)[1].lower() in TOP_LEVEL else 0
        layout = 1 if said.split("@")[0][:1].isalpha() else 0
    elif kind == 1:
        strict = 1 if all(p == str(int(p)) for p in said.split(".")) else -1
        gazetteer = -1 if said.split(".")[0] in ("0", "127", "255") else 0
        layout = 1 if len(said) >= 9 else -1
    elif kind in (2, 7):
        strict = 1 if luhn(digits) else -1
        gazetteer = 1 if digits.startswith(CARD_STARTS) else -1
        layout = 1 if len(digits) in (15, 16) else 0
    elif kind == 3:
        strict = 1
        gazetteer = 1 if digits.startswith(COUNTRY_CODES) else -1
        layout = 1 if any(c in said for c in " ()-.") else 0
    elif kind == 4:
        area = digits[:3]
        strict = 1 if area[0] not in "01" else -1
        gazetteer = 1 if digits[3:6] == "555" else 0
        layout = 1 if said[0] == "(" else 0
    elif kind == 5:
        strict = 1 if digits[:3] not in ("000", "666") and digits[0] != "9" \
            and digits[3:5] != "00" and digits[5:] != "0000" else -1
    elif kind == 6:
        strict = 1 if iban_valid(said) else -1
        gazetteer = 1 if said[:2] in IBAN_COUNTRIES else -1
        layout = 1 if 15 <= len(said.replace(" ", "")) <= 34 else -1
    else:
        names = said.split()[1:]
        gazetteer = 1 if names and names[0].lower() in GIVEN_NAMES else 0
        layout = 1 if len(names) == 2 else 0
        strict = 1 if all(len(n) > 2 for n in names) else -1
    before = re.findall(r"[^\W\d_]+(?:-[^\W\d_]+)*", text[max(0, start - 48):start].lower())[-4:]
    context = 1 if CUES_FOR & set(before) else -1 if CUES_AGAINST & set(before) else 0
    return strict, gazetteer, context, layout


def pattern_of(text: str, span: tuple[int, int, int]) -> tuple[int, ...]:
    """Kind, votes, and the shape: a length class and whether separators are inside."""
    size = span[2] - span[0]
    said = text[span[0]:span[2]]
    return (span[1], *votes(text, span), min(3, size // 8), int(any(c in " -()." for c in said)))


def _touched(data: np.ndarray, offsets: np.ndarray):
    """Documents with an at sign, a digit chain long enough for a candidate, or a title."""
    raw = data.tobytes()
    table = np.zeros(256, np.uint8)
    table[48:58] = 1
    table[[ord(c) for c in " -().+"]] = 1
    words = textscan.scan(data, offsets, table)
    wide = words.end - words.start >= 7  # the shortest address of four parts has 7 characters
    runs = words.start[wide]
    if len(runs):
        digits = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data >= 48) & (data < 58), out=digits[1:])
        runs = runs[digits[words.end[wide]] - digits[runs] >= 4]
    marks = np.concatenate([runs, np.flatnonzero(data == 64)])
    places = [p for title in TITLES for p in _places(raw, title + b" ") + _places(raw, title + b".")
              + _places(raw, title + b"s") + _places(raw, title + b"a")]
    marks = np.concatenate([marks, np.array(places, np.int64)])
    # A bank account is a long run of capitals and digits.
    table[:] = 0
    table[48:58] = table[65:91] = 1
    accounts = textscan.scan(data, offsets, table)
    marks = np.concatenate([marks, accounts.start[accounts.end - accounts.start >= 4]])
    for d in np.unique(np.searchsorted(offsets, marks, side="right") - 1):
        yield int(d), raw[offsets[d]:offsets[d + 1]].decode("utf-8")


def _places(data: bytes, needle: bytes) -> list[int]:
    out, at = [], data.find(needle)
    while at >= 0:
        out.append(at)
        at = data.find(needle, at + 1)
    return out


PATTERN = ["kind", "v0", "v1", "v2", "v3", "size", "split"]


def _count_batches(batches):
    seen: dict[tuple, int] = {}
    for batch in batches:
        data, offsets = text_buffers(batch.column(0))
        for a, b in slices(offsets):
            for _, text in _touched(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]):
                base = base_spans(text)
                for span in base + wider_spans(text, base):
                    key = pattern_of(text, span)
                    seen[key] = seen.get(key, 0) + 1
    keys = sorted(seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[i] for k in keys], pa.int32()) for i in range(len(PATTERN))]
        + [pa.array([seen[k] for k in keys], pa.int64())], [*PATTERN, "n"])


def estimate(kinds: np.ndarray, ballots: np.ndarray, n: np.ndarray, params: PiiParams):
    """EM for labelers that are right with a fixed probability whenever they vote.

    Returns the posterior of each row, each labeler's accuracy, and each kind's share of personal
    data. Accuracies are shared by all kinds and kept above one half, so that votes keep their
    meaning; shares are smoothed by one candidate of each sort.
    """
    accuracy = np.full(ballots.shape[1], params.start_accuracy)
    share = np.full(len(KINDS), 0.5)
    post = np.full(len(n), 0.5)
    for _ in range(params.rounds):
        log_odds = np.log(share[kinds] / (1 - share[kinds])) + (
            ballots * np.log(accuracy / (1 - accuracy))).sum(axis=1)
        after = 1 / (1 + np.exp(-log_odds))
        right = np.where(ballots > 0, after[:, None], 1 - after[:, None]) * (ballots != 0)
        accuracy = np.clip(((right * n[:, None]).sum(axis=0) + 4 * params.start_accuracy)
                           / (((ballots != 0) * n[:, None]).sum(axis=0) + 4), 0.55, 0.99)
        share = np.array([(1 + (after * n)[kinds == k].sum()) / (2 + n[kinds == k].sum())
                          for k in range(len(KINDS))])
        done = np.abs(after - post).max(initial=0) < 1e-9
        post = after
        if done:
            break
    return post, accuracy, share


def features(patterns: np.ndarray) -> np.ndarray:
    """Design matrix: kind, votes as for and against, length class, separators."""
    kind, ballots = patterns[:, 0], patterns[:, 1:1 + LABELERS]
    return np.concatenate([
        np.eye(len(KINDS))[kind], ballots > 0, ballots < 0,
        np.eye(4)[patterns[:, 1 + LABELERS]], patterns[:, 2 + LABELERS:3 + LABELERS]],
        axis=1).astype(np.float64)


def fit_classifier(x: np.ndarray, target: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Ridge logistic regression on soft targets, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (p - target)) + 0.1 * w
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


@dataclass(frozen=True)
class SpanModel:
    weights: np.ndarray
    accuracy: np.ndarray
    share: np.ndarray

    def probability(self, pattern: tuple[int, ...]) -> float:
        z = features(np.array([pattern])) @ self.weights
        return float(1 / (1 + np.exp(-np.clip(z[0], -30, 30))))


def learn(docs: DataFrame, params: PiiParams = PiiParams()) -> SpanModel:
    """Reliabilities and classifier from the vote counts of all documents.

    The counts have at most kinds x 3^4 votes x 8 shapes rows.
    """
    counts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(
        _count_batches, ", ".join(f"{c} int" for c in PATTERN) + ", n long") \
        .groupBy(*PATTERN).agg(F.sum("n").alias("n")).orderBy(*PATTERN).collect()
    if not counts:
        size = features(np.zeros((1, len(PATTERN)), np.int64)).shape[1]
        return SpanModel(np.zeros(size), np.full(LABELERS, params.start_accuracy),
                         np.full(len(KINDS), 0.5))
    table = np.array([list(r)[:-1] for r in counts], np.int64)
    n = np.array([r["n"] for r in counts], np.float64)
    post, accuracy, share = estimate(table[:, 0], table[:, 1:1 + LABELERS], n, params)
    return SpanModel(fit_classifier(features(table), post, n), accuracy, share)


_FOUND = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32()),
                             ("probability", pa.float64())]))


def _said(spans) -> str:
    return ",".join(f"{KINDS[s[1]]}:{s[0]}:{s[2]}" for s in spans)


def _find_batches(model: SpanModel, params: PiiParams):
    def run(batches):
        known: dict[tuple, float] = {}

        def sure(text, span):
            key = pattern_of(text, span)
            if key not in known:
                known[key] = model.probability(key)
            return known[key]

        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for a, b in slices(offsets):
                base, every = [[] for _ in range(b - a)], [[] for _ in range(b - a)]
                for d, text in _touched(data[offsets[a]:offsets[b]],
                                        offsets[a:b + 1] - offsets[a]):
                    base[d] = base_spans(text)
                    added = [(*s, sure(text, s)) for s in wider_spans(text, base[d])]
                    every[d] = sorted([(*s, sure(text, s)) for s in base[d]]
                                      + [s for s in added if s[3] >= params.threshold])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a),
                     *[pa.array([sum(s[1] == k for s in e) for e in every], pa.int64())
                       for k in range(len(BASE_KINDS))],
                     pa.array([hashlib.sha256(_said(s).encode()).hexdigest() for s in base]),
                     pa.array([_said(s) for s in every], pa.string()),
                     pa.array([[{"start": s[0], "kind": KINDS[s[1]], "end": s[2],
                                 "probability": round(s[3], 6)} for s in e] for e in every],
                              _FOUND)],
                    ["doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans", "found"])
    return run


def find_pii(docs: DataFrame, params: PiiParams = PiiParams()) -> DataFrame:
    """Personal data in every row of ``docs(doc_id, text)``.

    Returns ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` and ``found``, the spans
    as an array of (start, kind, end, probability). Positions are code points, ends exclusive.

    Null or empty text: nothing found. Null doc_id: returned as such. Repeated rows: returned
    each, and each counts in the estimates. An empty table gives an empty result; extra columns
    are ignored.
    """
    ship_code(docs.sparkSession)
    docs = only(docs, doc_id="long", text="string")
    numbers = ", ".join(f"n_{k} long" for k in BASE_KINDS)
    return docs.mapInArrow(
        _find_batches(learn(docs, params), params),
        f"doc_id long, {numbers}, base_sha256 string, spans string, "
        "found array<struct<start int, kind string, end int, probability double>>")
