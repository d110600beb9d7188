"""Quality rules: base text rules, and n-gram perplexity within language-specific bands.

Two modified Kneser-Ney models per language. One has order 5 over the bytes as they are; the other
has order 4 over bytes mapped to 64 classes (letters by case, digits, space, line end, punctuation,
symbols, groups of the bytes beyond ASCII), so a folded 4-gram follows from a 5-gram. Spark counts
the 5-grams of all documents once; folded counts, lower orders (continuation counts), discounts
(counts of counts) and probabilities are aggregates and joins over rows of distinct n-grams, and no
language is one group. What is counted has no bound and grows with the corpus.

Look-up follows the text, not the model. Rows that lie together in a file are a part of about
``PART_BYTES`` of text. The counting pass writes each part's distinct 5-grams; a join gives them
their values under both models; they are written by part. A scoring task reads the values of the
part that it is at, as one sorted array of 64-bit hashes, and never any other. Every document is in
the corpus, so each of its n-grams is there and back-off is needed only in building. Values are
fixed-point logs: the sum of a document does not depend on batching.

Verdict: under both models, the mean negative log probability of a byte is compared with the
median of the document's language. The allowed distances below and above are ``lower_width`` and
``upper_width`` median absolute deviations (``long_lower_width`` and ``long_upper_width`` under the
model of order 5), wider for short texts, whose means vary more.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm import textscan
from wardflow.llm.common import (file_system, scratch_path, ship_code, slices, text_buffers,
                                 written)

ORDER = 4
BITS = 6
FIXED = 1 << 16
BINS = 2000
#: Characters counted as symbols by the base rules (fixed values).
SYMBOLS = b"#*$%&|<>"
#: Entries a counting task gathers before it hands them on; counts add up, so this is no cap.
FLUSH = 4_000_000
#: The order of the model of bytes as they are.
LONG = 5
#: Text that shares one array of values, and rows of values in a folder of parts.
PART_BYTES = 32_000_000
RANGE_ROWS = 1_000_000


@dataclass(frozen=True)
class QualityParams:
    min_words: int = 50
    max_repeat_percent: int = 50
    # Chosen on the labelled rows of sf0.1 and sf0.01; README has the junk caught and clean lost.
    lower_width: float = 5.0
    upper_width: float = 6.0
    long_lower_width: float = 7.0
    long_upper_width: float = 8.0
    short: int = 1000  # bytes at which the band is wider by the square root of two


def byte_classes() -> np.ndarray:
    """The class of each byte; 64 classes at most, so that one fits 6 bits."""
    out = np.full(256, 62, np.uint8)
    out[97:123] = np.arange(26)
    out[65:91] = 26 + np.arange(26)
    out[48:58] = 52
    out[32], out[10] = 53, 54
    out[[ord("."), ord(",")]] = 55
    out[list(SYMBOLS)] = 63
    out[0xC0:] = 56
    out[0x80:0xC0] = 57 + np.arange(0x40) % 5
    return out


def folded(gram: Column) -> Column:
    """The folded 4-gram of an unfolded 5-gram: the classes of its last four bytes."""
    classes = F.array(*[F.lit(c) for c in byte_classes().tolist()])
    out = F.lit(0).cast("long")
    for back in range(ORDER):
        byte = F.shiftright(gram, 8 * back).bitwiseAND(F.lit(255).cast("long")).cast("int")
        out = out.bitwiseOR(F.shiftleft(F.element_at(classes, byte + 1).cast("long"), BITS * back))
    return out


def long_ids(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The unfolded 5-gram that ends at each byte; documents begin with line ends."""
    now = data.astype(np.uint64)
    out = now.copy()
    begins = offsets[:-1][np.diff(offsets) > 0]
    for back in range(1, LONG):
        before = np.full(len(now), 10, np.uint64)
        before[back:] = now[:-back]
        for j in range(back):
            place = begins + j
            before[place[place < len(now)]] = 10
        out |= before << np.uint64(8 * back)
    return out


def _count_batches(batches):
    """Rows of (part, slot, gram, c): how often each 5-gram occurs in a part, as seen by a task."""
    width = 8 * LONG
    codes: dict[tuple[int, str], int] = {}
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    waiting: list[np.ndarray] = []

    def merged():
        k = np.concatenate([keys, *[w[0] for w in waiting]])
        c = np.concatenate([counts, *[w[1] for w in waiting]])
        order = np.argsort(k)
        k, c = k[order], c[order]
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else []
        return (k[first], np.add.reduceat(c, first)) if len(k) else (k, c)

    def emitted(k, c):
        parts = np.array([part for part, _ in codes], np.int64)
        names = np.array([*[slot for _, slot in codes], ""], dtype=object)
        for a in range(0, len(k), 200_000):
            some = k[a:a + 200_000]
            code = (some >> np.uint64(width)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts[code]), pa.array(names[code], pa.string()),
                 pa.array((some & np.uint64((1 << width) - 1)).astype(np.int64)),
                 pa.array(c[a:a + 200_000])], ["part", "slot", "gram", "c"])

    for batch in batches:
        named = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        data, offsets = text_buffers(batch.column(2))
        for a, b in slices(offsets):
            code = np.array([codes.setdefault(s, len(codes)) for s in named[a:b]], np.uint64)
            off = offsets[a:b + 1] - offsets[a]
            ids = long_ids(data[offsets[a]:offsets[b]], off)
            for one in np.unique(code):
                mine = ids if (code == one).all() else ids[np.repeat(code == one, np.diff(off))]
                mine = np.sort(mine)
                if not len(mine):
                    continue
                first = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
                waiting.append((mine[first].astype(np.uint64) | one << np.uint64(width),
                                np.diff(np.append(first, len(mine)))))
            if sum(len(w[0]) for w in waiting) > 1_000_000:
                keys, counts = merged()
                waiting = []
                if len(keys) > FLUSH:
                    yield from emitted(keys, counts)
                    keys, counts, codes = keys[:0], counts[:0], {}
    yield from emitted(*merged())


def _discounts(level: DataFrame) -> DataFrame:
    """Per language, what is taken off counts of 1, 2, and 3 or more; from the counts of counts."""
    n = [F.sum(F.when(F.col("c") == i, 1).otherwise(0)).alias(f"n{i}") for i in (1, 2, 3, 4)]
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

    def step(i: int, default: float):
        here, above = F.col(f"n{i}"), F.col(f"n{i + 1}")
        raw = F.when((here > 0) & (above > 0),
                     i - (i + 1) * F.coalesce(F.when((F.col("n1") > 0) & (F.col("n2") > 0), y),
                                              F.lit(0.5)) * above / here).otherwise(default)
        return F.least(F.greatest(raw, F.lit(0.05)), F.lit(i - 0.05)).alias(f"d{i}")

    return level.groupBy("slot").agg(*n).select(
        "slot", step(1, 0.5), step(2, 1.0), step(3, 1.5))


def kneser_ney(top: DataFrame, order: int, bits: int) -> DataFrame:
    """``(slot, gram, p)`` for every n-gram of ``top(slot, gram, c)``; ``bits`` hold a symbol.

    What has one row per language is written, so that its joins go by its measured size.
    """
    def suffix(n: int):
        return F.col("gram").bitwiseAND(F.lit((1 << bits * n) - 1).cast("long"))

    levels = {order: top}
    for n in range(order - 1, 0, -1):
        levels[n] = written(levels[n + 1].select("slot", suffix(n).alias("gram")).groupBy(
            "slot", "gram").agg(F.count("gram").alias("c")), "grams", True)
    totals = written(levels[1].groupBy("slot").agg(F.sum("c").alias("total")), "totals", True)
    lower = levels[1].join(totals, "slot").select(
        "slot", "gram", (F.lit(0.01 / (1 << bits)) + F.lit(0.99) * F.col("c") / F.col("total"))
        .alias("p"))
    for n in range(2, order + 1):
        off = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(
            F.col("d3"))
        rows = levels[n].join(written(_discounts(levels[n]), "discounts", True), "slot").select(
            "slot", "gram", "c", off.alias("off"), F.shiftright("gram", bits).alias("context"),
            suffix(n - 1).alias("suffix"))
        # Exact sums whatever the order of the rows: a discount is one of three values.
        contexts = rows.groupBy("slot", "context").agg(
            F.sum("c").alias("total"),
            F.sum(F.col("off").cast("decimal(20,12)")).cast("double").alias("taken"))
        lower = written(rows.join(contexts, ["slot", "context"]).join(
            lower.select("slot", F.col("gram").alias("suffix"), F.col("p").alias("below")),
            ["slot", "suffix"]).select(
            "slot", "gram", ((F.col("c") - F.col("off") + F.col("taken") * F.col("below"))
                             / F.col("total")).alias("p")), "probabilities", True)
    return lower


def count_parts(docs: DataFrame) -> DataFrame:
    """``(part, slot, gram, c)`` of ``docs(part, slot, text)``; a part's rows may repeat a gram."""
    return written(docs.select("part", "slot", "text").mapInArrow(
        _count_batches, "part long, slot string, gram long, c long"), "part-grams")


def _total(rows: DataFrame) -> DataFrame:
    return written(rows.groupBy("slot", "gram").agg(F.sum("c").alias("c")), "grams", True)


def long_probabilities(docs: DataFrame) -> DataFrame:
    """``(slot, gram, p)`` for every 5-gram of ``docs(slot, text)``."""
    return kneser_ney(_total(count_parts(docs.withColumn("part", F.lit(0).cast("long")))), LONG, 8)


def folded_probabilities(top: DataFrame) -> DataFrame:
    """``(slot, gram, p)`` for every folded 4-gram, from the counts of 5-grams."""
    return kneser_ney(_total(top.select("slot", folded(F.col("gram")).alias("gram"), "c")),
                      ORDER, BITS)


def _fixed(p: str) -> Column:
    return F.rint(F.log(p) * F.lit(float(FIXED))).cast("int")


def write_values(docs: DataFrame) -> tuple[str, int]:
    """The values of each part's distinct 5-grams, in a folder of ``n`` folders of parts."""
    parts = count_parts(docs)
    top = _total(parts)
    small = folded_probabilities(top).select(
        "slot", F.col("gram").alias("small"), _fixed("p").alias("value"))
    model = written(kneser_ney(top, LONG, 8).select(
        "slot", "gram", folded(F.col("gram")).alias("small"), _fixed("p").alias("long_value"))
        .join(small, ["slot", "small"]).drop("small"), "model", True)
    n = 1 + parts.count() // RANGE_ROWS
    path = scratch_path(docs.sparkSession, "values")
    parts.select("part", "slot", "gram").join(model, ["slot", "gram"]).withColumn(
        "folder", _folder(n)).hint("rebalance", "folder").sortWithinPartitions("folder", "part") \
        .write.partitionBy("folder").parquet(path)
    return path, n


def _folder(n: int) -> Column:
    return F.pmod(F.xxhash64("part"), F.lit(n)).alias("folder")


def long_keys(ids: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """One hash for a 5-gram and its language; distinct for the 5-grams of a language."""
    return textscan.mix(ids + slots, 7)


def slot_numbers(slots: pa.Array) -> np.ndarray:
    coded = pa.chunked_array([slots]) if isinstance(slots, pa.Array) else slots
    coded = coded.combine_chunks().dictionary_encode()
    names = np.array([int(s, 16) for s in coded.dictionary.to_pylist()], np.uint64)
    return names[coded.indices.to_numpy()] if len(names) else np.zeros(0, np.uint64)


class PartValues:
    """The values of a part's 5-grams under both models: a sorted array of hashes.

    ``first`` holds, for each leading run of bits, the place of the first hash that is not below
    it; hashes are mixed, so the wanted one is there or a step or two behind.
    """

    def __init__(self, rows: pa.Table):
        keys = long_keys(rows["gram"].to_numpy().astype(np.uint64), slot_numbers(rows["slot"]))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.values = [rows[c].to_numpy()[order] for c in ("value", "long_value")]
        # At most two places per hash, counted from the leading bits: no array of 64-bit bounds.
        bits = max(1, len(keys).bit_length())
        self.shift = np.uint64(64 - bits)
        below = np.bincount((self.keys >> self.shift).astype(np.int64), minlength=1 << bits)
        self.first = np.zeros(1 << bits, np.int32)
        np.cumsum(below[:-1], out=self.first[1:])

    def places(self, wanted: np.ndarray) -> np.ndarray:
        place = self.first[wanted >> self.shift]
        left = np.arange(len(wanted))
        while len(left):
            at = place[left]
            if at.max() >= len(self.keys) or (self.keys[at] > wanted[left]).any():
                raise ValueError("n-grams are missing: the documents changed while they were read")
            left = left[self.keys[at] < wanted[left]]
            place[left] += 1
        return place


def load_values(path: str, folder: int, part: int) -> PartValues:
    """The values of one part from the shared folder."""
    where, inner = file_system(f"{path}/folder={folder}")
    found = [pq.read_table(f.path, columns=["slot", "gram", "value", "long_value"],
                           filters=[("part", "==", part)], filesystem=where, partitioning=None)
             for f in where.get_file_info(pafs.FileSelector(inner))
             if f.base_name.endswith(".parquet")]
    rows = pa.concat_tables(found)
    del found
    values = PartValues(rows)
    del rows
    pa.default_memory_pool().release_unused()  # the rows are numpy arrays now
    return values


def _sums(per_item: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(per_item) + 1, np.int64)
    np.cumsum(per_item, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def repeated_words(words: textscan.Words) -> np.ndarray:
    """Per document, the words inside 3-word windows found at least twice in it."""
    n = len(words.hash)
    count = np.zeros(len(words.first) - 1, np.int64)
    if n < 3:
        return count
    doc = words.doc()
    windows = textscan.shingle_hashes(words.hash, 3)
    inside = doc[:-2] == doc[2:]
    windows = textscan.mix(windows + doc[:-2].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 9)
    ordered = np.sort(windows[inside])
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return count
    place = np.minimum(np.searchsorted(twice, windows), len(twice) - 1)
    again = (twice[place] == windows) & inside
    covered = np.zeros(n, bool)
    for j in range(3):
        covered[j:n - 2 + j] |= again
    return _sums(covered, words.first)


def duplicate_lines(raw: bytes) -> int:
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def base_features(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each document ``data[offsets[d] : offsets[d + 1]]``."""
    words = textscan.scan(data, offsets, textscan.space_table(False))
    points = textscan.code_points(data)
    raw = data.tobytes()
    is_symbol = np.zeros(256, bool)
    is_symbol[list(SYMBOLS)] = True
    chars = points[words.end] - points[words.start]
    breaks = _sums(data == 10, offsets)
    return {
        "n_words": np.diff(words.first),
        "word_chars": _sums(chars, words.first),
        "n_symbols": _sums(is_symbol[data], offsets),
        "n_dup_lines": np.array([duplicate_lines(raw[a:b]) if k else 0 for a, b, k in
                                 zip(offsets[:-1], offsets[1:], breaks)], np.int64),
        "n_repeat_words": repeated_words(words),
    }


FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _score_batches(path: str):
    def run(batches):
        here, values = None, None
        for batch in batches:
            part = batch.column(2).to_numpy(zero_copy_only=False)
            data, offsets = text_buffers(batch.column(4))
            begins = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) \
                if len(part) else []
            for begin, end in zip(begins, [*begins[1:], len(part)]):
                for a, b in slices(offsets[begin:end + 1]):
                    a, b = a + begin, b + begin
                    text, off = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                    sums = [np.zeros(b - a, np.int64)] * 2
                    if len(text):
                        if here != part[a]:
                            here, values = part[a], None  # one part's values at a time
                            values = load_values(path, batch.column(3)[int(a)].as_py(), int(here))
                        slots = slot_numbers(batch.column(1).slice(a, b - a))
                        place = values.places(long_keys(long_ids(text, off),
                                                        np.repeat(slots, np.diff(off))))
                        sums = [_sums(v[place], off) for v in values.values]
                    features = base_features(text, off)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                         *[pa.array(features[f]) for f in FEATURES],
                         *[pa.array(x) for x in sums], pa.array(np.diff(off))],
                        ["doc_id", "slot", *FEATURES, "lp", "long_lp", "n_bytes"])
    return run


def _middle(rows: DataFrame, value, name: str) -> DataFrame:
    """The median of ``value`` per slot to 1 / BINS, from counts of whole bins."""
    # At most one row per language and bin: the range of a mean log probability, not the corpus.
    # Written, so that the window by language gets these rows and not those of every task.
    counts = written(rows.select("slot", F.floor(value * BINS).alias("bin"))
                     .groupBy("slot", "bin").count(), "bins", True)
    order = Window.partitionBy("slot").orderBy("bin")
    seen = counts.select(
        "slot", "bin", F.sum("count").over(order).alias("upto"),
        F.sum("count").over(Window.partitionBy("slot")).alias("all"))
    return seen.where("upto * 2 >= all").groupBy("slot").agg(
        (F.min("bin") / F.lit(float(BINS))).alias(name))


def _banded(scored: DataFrame, lp: str, prefix: str, widths: tuple[float, float],
            short: int) -> DataFrame:
    """``scored`` with the mean of ``lp`` and its language's limits, named with ``prefix``."""
    size = F.nullif(F.col("n_bytes"), F.lit(0))  # no text, no mean and no band
    mean = -F.col(lp) / F.lit(float(FIXED)) / size
    shrink = F.sqrt(size / (size + F.lit(float(short))))
    some = scored.where("n_bytes > 0").select("slot", "n_bytes", mean.alias("mean"))
    center = _middle(some, F.col("mean"), "center")
    spread = _middle(some.join(center, "slot"),
                     F.abs(F.col("mean") - F.col("center")) * shrink, "spread")
    bands = written(center.join(spread, "slot").select(
        "slot", "center", F.greatest("spread", F.lit(1.0 / BINS)).alias("spread")), "bands")
    lower = F.col("center") - F.lit(widths[0]) * F.col("spread") / shrink
    upper = F.col("center") + F.lit(widths[1]) * F.col("spread") / shrink
    return scored.join(bands, "slot", "left").withColumns({
        f"{prefix}mean": mean, f"{prefix}lower": lower, f"{prefix}upper": upper}
    ).drop("center", "spread")


def row_place() -> Column:
    """Where a row of a plain table lies, the same however often the table is read."""
    return F.struct(F.xxhash64("_metadata.file_path").alias("file"),
                    F.col("_metadata.row_index").alias("index"))


def _in_parts(docs: DataFrame, at: str | None) -> DataFrame:
    """``docs(doc_id, slot, text, part)``; a part is a run of a file's rows."""
    slot = F.lower(F.hex(F.xxhash64(F.coalesce(F.col("lang").cast("string"), F.lit("\u0000")))))
    columns = [F.col("doc_id").cast("long").alias("doc_id"), slot.alias("slot"),
               F.col("text").cast("string").alias("text")]
    if at:
        placed = docs.select(*columns, F.col(at).alias("at"))
    else:
        try:
            placed = docs.select(*columns, row_place().alias("at"))
        except AnalysisException:  # no plain table: written as one first
            placed = written(docs.select("doc_id", "lang", "text"), "rows").select(
                *columns, row_place().alias("at"))
    size = placed.agg(F.count("at").alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    rows = max(1, PART_BYTES * size["n"] // max(1, size["b"] or 0))
    part = F.xxhash64("at.file", F.floor(F.col("at.index") / F.lit(rows)))
    return placed.select("doc_id", "slot", "text", part.alias("part"))


def judge_quality(docs: DataFrame, params: QualityParams = QualityParams(),
                  at: str | None = None) -> DataFrame:
    """The base counts and the verdict for every row of ``docs(doc_id, text, lang)``.

    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeat_percent`` percent
    of the words inside 3-word windows found twice or more. ``kept`` is false if that failed or
    the perplexity is outside the band of the document's language, under either model.
    ``perplexity`` and ``long_perplexity`` are per byte.

    Null or empty text: all counts 0, perplexity null, base_failed, not kept. Null language: a
    language of its own. Every row is returned, repeated ones too; an empty table gives an empty
    result; extra columns are ignored. The models and the bands are learned from all rows with
    text. ``at`` names a column of ``row_place()``, for documents that are no plain table any more;
    without it, such documents are written as a table first.
    """
    spark = docs.sparkSession
    ship_code(spark)
    docs = _in_parts(docs, at)
    path, n = write_values(docs)
    scored = written(docs.select("doc_id", "slot", "part", _folder(n), "text").mapInArrow(
        _score_batches(path),
        "doc_id long, slot string, n_words long, word_chars long, n_symbols long, "
        "n_dup_lines long, n_repeat_words long, lp long, long_lp long, n_bytes long"), "scored")
    rows = _banded(scored, "lp", "", (params.lower_width, params.upper_width), params.short)
    rows = _banded(rows, "long_lp", "long_",
                   (params.long_lower_width, params.long_upper_width), params.short)
    base_failed = (F.col("n_words") < params.min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * params.max_repeat_percent)
    inside = F.col("mean").between(F.col("lower"), F.col("upper")) & F.col("long_mean").between(
        F.col("long_lower"), F.col("long_upper"))
    return rows.select(
        "doc_id", *FEATURES, base_failed.alias("base_failed"),
        (~base_failed & F.coalesce(inside, F.lit(False))).alias("kept"),
        F.exp("mean").alias("perplexity"),
        F.exp("lower").alias("lower_band"), F.exp("upper").alias("upper_band"),
        F.exp("long_mean").alias("long_perplexity"),
        F.exp("long_lower").alias("long_lower_band"), F.exp("long_upper").alias("long_upper_band"))
