"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, check.

Every benchmark item of L words is compared with every window of L words of every document (a
document with fewer words is one window). Items and windows are multisets of 5-word shingles,
weighted by how often a shingle occurs; similarity is weighted Jaccard, and 0.8 makes a match.

A window of L words can only match when shingles of items of L words make up 80 % of such an item,
because the common weight is at most that of those shingles. A Bloom filter of fixed size over all
items' shingles, alone and together with the length (a superset, so nothing is lost), leaves such
windows; the others have a similarity below 0.8.

The remaining windows get 64-bit SimHash fingerprints. Fingerprints are cut into 5 blocks of 13 or
12 bits; two that differ in at most 19 bits differ in at most 3 bits of some block, so the index
lists every item under each value within 3 bits of each of its blocks, and an equi-join of
(length, block, value) finds all fingerprints within the radius. At a similarity of exactly 0.8
two fingerprints differ in 9.7 bits on average, and in more than 19 with a probability below one
in a thousand. Candidates are then verified on their whole shingle multisets.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm import textscan
from wardflow.llm.common import only, ship_code, slices, text_buffers, written

#: First bit and width of each block of a fingerprint.
BLOCKS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]
#: Bits of the filter, whatever the size of the benchmark; more items only let more windows pass.
FILTER_BITS = 1 << 24


@dataclass(frozen=True)
class LeakParams:
    shingle: int = 5
    percent: int = 80
    radius: int = 19


def word_table() -> np.ndarray:
    """Words are runs of letters, digits and bytes beyond ASCII, with A-Z folded."""
    out = textscan.letter_table()
    out[48:58] = np.arange(48, 58)
    return out


def counted(shingles: np.ndarray) -> np.ndarray:
    """A multiset as a set: the n-th occurrence of a shingle gets a value of its own."""
    ordered = np.sort(shingles)
    if len(ordered) < 2 or (ordered[1:] != ordered[:-1]).all():
        return ordered
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    turn = np.arange(len(ordered)) - np.repeat(first, np.diff(np.append(first, len(ordered))))
    again = textscan.mix(ordered + turn.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 77)
    return np.where(turn > 0, again, ordered)


def bit_sums(shingles: np.ndarray) -> np.ndarray:
    """Running sums of +1 / -1 per bit; row i covers the shingles before i."""
    bits = np.unpackbits(textscan.mix(shingles, 41).astype("<u8").view(np.uint8).reshape(-1, 8),
                         axis=1, bitorder="little")
    out = np.zeros((len(shingles) + 1, 64), np.int32)
    np.cumsum(bits.astype(np.int32) * 2 - 1, axis=0, out=out[1:])
    return out


def fingerprints(sums: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the windows ``start : start + size``."""
    on = (sums[start + size] - sums[start]) > 0
    return np.packbits(on, axis=1, bitorder="little").reshape(-1).view("<u8").astype(np.uint64)


def _filter_places(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = textscan.mix(shingles, 51)
    return ((h >> np.uint64(40)).astype(np.int64) % FILTER_BITS,
            (h & np.uint64(FILTER_BITS - 1)).astype(np.int64))


def _with_length(shingles: np.ndarray, length) -> np.ndarray:
    lengths = np.broadcast_to(np.asarray(length, np.uint64), shingles.shape)
    return textscan.mix(shingles + lengths * np.uint64(0x9E3779B97F4A7C15), 63)


def _in_filter(bits: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    out = np.ones(len(shingles), bool)
    for place in _filter_places(shingles):
        out &= (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
    return out


def _item_batches(shingle: int):
    def run(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            words = textscan.scan(data, offsets, word_table())
            rows = {n: [] for n in ("item_id", "length", "fp", "shingles")}
            for d, item in enumerate(batch.column(0).to_pylist()):
                own = words.hash[words.first[d]:words.first[d + 1]]
                if not len(own) or item is None:
                    continue
                parts = textscan.shingle_hashes(own, min(shingle, len(own)))
                fp = fingerprints(bit_sums(parts), np.zeros(1, np.int64), len(parts))
                rows["item_id"].append(item)
                rows["length"].append(len(own))
                rows["fp"].append(int(fp.view(np.int64)[0]))
                rows["shingles"].append(counted(parts).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["item_id"], pa.int64()), pa.array(rows["length"], pa.int32()),
                 pa.array(rows["fp"], pa.int64()),
                 pa.array(rows["shingles"], pa.list_(pa.int64()))], list(rows))
    return run


def _neighbours(radius: int, width: int) -> list[int]:
    """All patterns of a block with at most as many set bits as one block must have at least."""
    near = radius // len(BLOCKS)
    return [sum(1 << b for b in bits) for n in range(near + 1)
            for bits in itertools.combinations(range(width), n)]


def _window_batches(bits_of, lengths: list[int], params: LeakParams):
    """Windows with enough filter hits: document, first word, length, fingerprint, shingles."""
    def windows_of(bits: np.ndarray, own: np.ndarray, hits: dict[int, np.ndarray],
                   parts: dict[int, np.ndarray]):
        sums = {}
        for length in lengths:
            size = min(params.shingle, length)
            if len(own) < length:
                size = min(size, len(own))
            found, shingles = hits.get(size), parts.get(size)
            if found is None or not len(shingles):
                continue
            need_of = max(1, length - size + 1)
            wide = min(need_of, len(shingles))
            at = np.flatnonzero(found)
            at = at[_in_filter(bits, _with_length(shingles[at], length))]
            if len(at) * 100 < need_of * params.percent:
                continue
            ours = np.zeros(len(shingles), np.int64)
            ours[at] = 1
            total = np.concatenate([[0], np.cumsum(ours)])
            inside = total[wide:] - total[:-wide]
            # The common weight is at most the hits; the union is at least the item's weight.
            start = np.flatnonzero(inside * 100 >= need_of * params.percent)
            if not len(start):
                continue
            if size not in sums:
                sums[size] = bit_sums(shingles)
            for s, fp in zip(start, fingerprints(sums[size], start, wide)):
                yield int(s), length, int(fp.view(np.int64)), counted(shingles[s:s + wide])

    def run(batches):
        bits = np.frombuffer(bits_of.value, np.uint8)
        sizes = sorted({min(params.shingle, n) for n in lengths})
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, offsets = text_buffers(batch.column(1))
            rows = {n: [] for n in ("doc_id", "start", "length", "fp", "shingles")}
            for a, b in slices(offsets):
                words = textscan.scan(data[offsets[a]:offsets[b]],
                                      offsets[a:b + 1] - offsets[a], word_table())
                parts = {n: textscan.shingle_hashes(words.hash, n) for n in sizes}
                hits = {n: _in_filter(bits, p) for n, p in parts.items()}
                touched = np.zeros(b - a, bool)
                for n, found in hits.items():
                    at = np.flatnonzero(found)
                    touched[np.searchsorted(words.first, at, side="right") - 1] = True
                short = np.diff(words.first) < params.shingle
                for d in np.flatnonzero(touched | short):
                    lo, hi = words.first[d], words.first[d + 1]
                    own = words.hash[lo:hi]
                    if not len(own) or ids[a + d] is None:
                        continue
                    mine = {n: p[lo:max(lo, hi - n + 1)] for n, p in parts.items()}
                    found = {n: h[lo:max(lo, hi - n + 1)] for n, h in hits.items()}
                    if len(own) < params.shingle and len(own) not in mine:
                        mine[len(own)] = textscan.shingle_hashes(own, len(own))
                        found[len(own)] = _in_filter(bits, mine[len(own)])
                    for start, length, fp, shingles in windows_of(bits, own, found, mine):
                        rows["doc_id"].append(ids[a + d])
                        rows["start"].append(start)
                        rows["length"].append(length)
                        rows["fp"].append(fp)
                        rows["shingles"].append(shingles.view(np.int64))
                    if len(rows["doc_id"]) > 20_000:
                        yield _window_rows(rows)
                        rows = {n: [] for n in rows}
            yield _window_rows(rows)
    return run


def _window_rows(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(rows["doc_id"], pa.int64()), pa.array(rows["start"], pa.int32()),
         pa.array(rows["length"], pa.int32()), pa.array(rows["fp"], pa.int64()),
         pa.array(rows["shingles"], pa.list_(pa.int64()))], list(rows))


def _block(first: int, width: int):
    return F.shiftrightunsigned("fp", first).bitwiseAND((1 << width) - 1)


def _index(items: DataFrame, radius: int) -> DataFrame:
    """Every item under all values near each of its blocks."""
    parts = []
    for number, (first, width) in enumerate(BLOCKS):
        near = F.array(*[F.lit(x) for x in _neighbours(radius, width)])
        parts.append(items.select(
            "item_id", "length", F.col("fp").alias("item_fp"), F.lit(number).alias("block"),
            _block(first, width).alias("own"), F.explode(near).alias("flip")).select(
            "item_id", "length", "item_fp", "block",
            F.col("own").bitwiseXOR(F.col("flip")).alias("value")))
    return reduce(DataFrame.union, parts)


def find_leaks(docs: DataFrame, benchmark: DataFrame,
               params: LeakParams = LeakParams()) -> DataFrame:
    """Every (document, item) that match in some window, one row each.

    ``docs(doc_id, text)``, ``benchmark(item_id, text)``; returns ``doc_id, item_id, similarity,
    start_word, hamming, n_windows``: the most similar window (the first of equals) with its
    SimHash distance, and the number of windows that match.

    Null, empty or wordless texts match nothing, on either side; rows with a null id are left
    out, as there is nothing to report them by. Items or documents of fewer words than a shingle
    are one shingle of all their words. Rows that repeat an id are judged each and reported
    together under the id. Empty tables give an empty result. Extra columns are ignored.
    """
    spark = docs.sparkSession
    ship_code(spark)
    docs = only(docs, doc_id="long", text="string")
    items = written(only(benchmark, item_id="long", text="string").mapInArrow(
        _item_batches(params.shingle), "item_id long, length int, fp long, shingles array<long>"),
        "items")
    # At most one row per length that occurs, and FILTER_BITS / 64 rows of filter.
    lengths = [r["length"] for r in items.select("length").distinct().orderBy("length").collect()]
    bits_of = spark.sparkContext.broadcast(_filter_bytes(items))
    windows = written(docs.mapInArrow(
        _window_batches(bits_of, lengths, params),
        "doc_id long, start int, length int, fp long, shingles array<long>"), "windows")

    blocks = F.array(*[_block(first, width) for first, width in BLOCKS])
    probes = (windows.select("length", "fp").distinct()
              .select("length", "fp", F.posexplode(blocks).alias("block", "value")))
    hamming = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    # The index is some thousand entries per item: never a side to broadcast, whatever the
    # planner makes of the few items it comes from.
    close = written(
        probes.join(_index(items, params.radius).hint("merge"), ["length", "block", "value"])
        .select("length", "fp", "item_id", "item_fp", hamming.alias("hamming"))
        .where(F.col("hamming") <= params.radius).distinct(), "close")
    candidates = windows.join(close, ["length", "fp"]).join(
        items.select("item_id", "length", F.col("fp").alias("item_fp"),
                     F.col("shingles").alias("item_shingles")), ["item_id", "length", "item_fp"])
    common = F.size(F.array_intersect("shingles", "item_shingles"))
    verified = candidates.select(
        "doc_id", "item_id", "start", "hamming", common.alias("common"),
        (F.size("shingles") + F.size("item_shingles") - common).alias("whole")
    ).where(F.col("common") * 100 >= F.col("whole") * params.percent)
    best = F.max(F.struct((F.col("common") / F.col("whole")).alias("similarity"),
                          (-F.col("start")).alias("back"), (-F.col("hamming")).alias("far")))
    return verified.groupBy("doc_id", "item_id").agg(
        best.alias("best"), F.count("start").alias("n_windows")).select(
        "doc_id", "item_id", "best.similarity", (-F.col("best.back")).alias("start_word"),
        (-F.col("best.far")).alias("hamming"), "n_windows")


def _filter_batches(batches):
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        lengths = batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint64)
        place = np.unique(np.concatenate(
            _filter_places(values) + _filter_places(_with_length(values, lengths))))
        yield pa.RecordBatch.from_arrays(
            [pa.array(place >> 6),
             pa.array((np.uint64(1) << (place & 63).astype(np.uint64)).view(np.int64))],
            ["word", "bits"])


def _filter_bytes(items: DataFrame) -> bytes:
    """The filter over all items' shingles, at most FILTER_BITS / 64 words to the driver."""
    shingles = items.select(F.explode("shingles").alias("s"), "length")
    words = shingles.mapInArrow(_filter_batches, "word long, bits long") \
        .groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out.astype("<u8").tobytes()
