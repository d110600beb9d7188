"""Draw documents towards a target distribution, by importance weights of hashed n-grams.

Features are words and, with ``longest`` 2, pairs of neighbouring words; a feature's bucket is the
CRC-32 of its bytes modulo ``buckets``. A bucket's gain compares its share of the target texts
with its share of all documents, a document's weight adds the gains of its features, and Gumbel
noise from its id turns the highest sums into a draw without replacement.

Head and tail: text is skewed, so a bounded vocabulary of the most frequent words covers most of
it. Their exact CRC states are broadcast, and so are the buckets of the most frequent pairs of
such words. Every other feature takes the direct way: a tail word its CRC over all bytes, a pair
that is not in the table the CRC of its first word, continued over the blank and the second word.
Both ways give the same numbers, so the vocabulary decides about time and never about a result.

Within a slice of text a feature is worked out once for each distinct word or pair. Bucket totals
leave a task as at most ``buckets`` rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm import textscan
from wardflow.llm.common import only, ship_code, slices, text_buffers, written
from wardflow.llm.ordering import ranked

#: Distinct features a counting task gathers before it hands them on; counts add up.
FLUSH = 500_000


@dataclass(frozen=True)
class ResamplingParams:
    longest: int = 1
    buckets: int = 10_000
    percent: int = 10
    min_words: int = 20
    seed: str = "2024"
    head_words: int = 1 << 15  # bound of the broadcast vocabulary
    head_pairs: int = 1 << 15
    head_bytes: int = 64  # longer words are never part of it


def word_table() -> np.ndarray:
    """Byte classes of words: digits, letters with A-Z folded, and all bytes beyond ASCII."""
    out = textscan.letter_table()
    out[48:58] = np.arange(48, 58)
    return out


@dataclass
class Features:
    """The words of a slice: their distinct bytes, and which of them each word is."""

    distinct: list[bytes]
    which: np.ndarray
    first: np.ndarray  # document d has the words first[d] : first[d + 1]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs as numbers of words, which of them each pair is, and its document."""
        doc = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        inside = doc[1:] == doc[:-1]
        code = self.which[:-1][inside] * len(self.distinct) + self.which[1:][inside]
        codes, which = np.unique(code, return_inverse=True)
        return codes, which, doc[1:][inside]


def read_words(data: np.ndarray, offsets: np.ndarray) -> Features:
    table = word_table()
    words = textscan.scan(data, offsets, table)
    _, at, which = np.unique(words.hash, return_index=True, return_inverse=True)
    folded = table[data].tobytes()
    return Features([folded[a:b] for a, b in zip(words.start[at], words.end[at])], which,
                    words.first)


class Vocabulary:
    """CRC states of head words and buckets of head pairs; both may be empty."""

    def __init__(self, words: list[bytes], pairs: list[bytes], buckets: int):
        self.buckets = buckets
        self.states = {word: zlib.crc32(word) for word in words}
        self.pairs = {pair: zlib.crc32(pair) % buckets for pair in pairs}

    def word_states(self, distinct: list[bytes]) -> list[int]:
        head = self.states
        return [head[w] if w in head else zlib.crc32(w) for w in distinct]

    def pair_buckets(self, codes: np.ndarray, distinct: list[bytes],
                     states: list[int]) -> np.ndarray:
        out = np.zeros(len(codes), np.int64)
        for place, code in enumerate(codes.tolist()):
            one, two = divmod(code, len(distinct))
            tail = b" " + distinct[two]
            known = self.pairs.get(distinct[one] + tail)
            out[place] = zlib.crc32(tail, states[one]) % self.buckets if known is None else known
        return out


def feature_buckets(features: Features, vocabulary: Vocabulary,
                    longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For words, then for pairs: the bucket of each feature, and its document's number."""
    states = vocabulary.word_states(features.distinct)
    of_word = np.array(states, np.int64) % vocabulary.buckets
    counts = np.diff(features.first)
    yield of_word[features.which] if len(states) else features.which, np.repeat(
        np.arange(len(counts)), counts)
    if longest > 1 and len(features.which) > 1:
        codes, which, doc = features.pairs()
        if len(codes):
            yield vocabulary.pair_buckets(codes, features.distinct, states)[which], doc


def _slices_of(batch, column: int):
    data, offsets = text_buffers(batch.column(column))
    for a, b in slices(offsets):
        yield a, b, read_words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])


# --- the head ------------------------------------------------------------


def _emitted(counts: dict[bytes, int]):
    items = list(counts.items())
    for a in range(0, len(items), 20_000):
        part = items[a:a + 20_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in part], pa.binary()),
             pa.array([c for _, c in part], pa.int64())], ["feature", "c"])


def _count_batches(params: ResamplingParams, head=None):
    """How often each short word occurs; with ``head`` given, each pair of two of its words."""
    def counted(features: Features):
        if head is None:
            counts = np.bincount(features.which, minlength=len(features.distinct))
            for word, c in zip(features.distinct, counts.tolist()):
                if len(word) <= params.head_bytes:
                    yield word, c
            return
        codes, which, _ = features.pairs()
        words = features.distinct
        for code, c in zip(codes.tolist(), np.bincount(which, minlength=len(codes)).tolist()):
            one, two = divmod(code, len(words))
            if words[one] in head.value and words[two] in head.value:
                yield words[one] + b" " + words[two], c

    def run(batches):
        counts: dict[bytes, int] = {}
        for batch in batches:
            for _, _, features in _slices_of(batch, 0):
                for key, c in counted(features):
                    counts[key] = counts.get(key, 0) + c
                if len(counts) > FLUSH:
                    yield from _emitted(counts)
                    counts = {}
        yield from _emitted(counts)
    return run


def _most_frequent(texts: DataFrame, run, most: int) -> list[bytes]:
    """At most ``most`` features, the most frequent ones of all texts.

    Features are counted by how often they occur, in steps of an eighth of a power of two, a few
    hundred rows; the steps that fit are taken whole, so that no task and not the driver has to
    sort or hold more than the vocabulary.
    """
    counts = written(texts.mapInArrow(run, "feature binary, c long").groupBy("feature").agg(
        F.sum("c").alias("c")).withColumn("step", F.floor(F.log2("c") * 8)), "features", True)
    taken, lowest = 0, None
    for row in counts.groupBy("step").agg(F.count("c").alias("n")).orderBy(F.desc("step")).collect():
        taken += row["n"]
        if taken > most:
            break
        lowest = row["step"]
    if lowest is None:
        return []
    return [bytes(r["feature"]) for r in
            counts.where(F.col("step") >= lowest).select("feature").orderBy("feature").collect()]


def learn_vocabulary(texts: DataFrame, params: ResamplingParams) -> Vocabulary:
    words = _most_frequent(texts, _count_batches(params), params.head_words)
    pairs = []
    if params.longest > 1:
        head = texts.sparkSession.sparkContext.broadcast(frozenset(words))
        pairs = _most_frequent(texts, _count_batches(params, head), params.head_pairs)
    return Vocabulary(words, pairs, params.buckets)


# --- totals, gains, weights ----------------------------------------------


def _total_batches(shared, params: ResamplingParams):
    def run(batches):
        totals = np.zeros(params.buckets, np.int64)
        for batch in batches:
            for _, _, features in _slices_of(batch, 0):
                for buckets, _ in feature_buckets(features, shared.value, params.longest):
                    totals += np.bincount(buckets, minlength=params.buckets)
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(totals[some])],
                                         ["bucket", "c"])
    return run


def bucket_totals(texts: DataFrame, shared, params: ResamplingParams) -> DataFrame:
    """``(bucket, c)`` of all features of the texts."""
    return texts.mapInArrow(_total_batches(shared, params), "bucket long, c long") \
        .groupBy("bucket").agg(F.sum("c").alias("c"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """``(bucket, gain)`` of every bucket, in thousandths of a natural logarithm, rounded down."""
    def total(counts: DataFrame):
        return counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("all")).first()["all"]

    def shifted(value, by: int):
        return value.cast("double") + F.lit(float(by))

    s, t = F.coalesce("s", F.lit(0)), F.coalesce("t", F.lit(0))
    every = source.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    both = every.join(source.withColumnRenamed("c", "s"), "bucket", "left").join(
        target.withColumnRenamed("c", "t"), "bucket", "left")
    ratio = (shifted(t, 1) * shifted(F.lit(total(source)), buckets)) / (
        shifted(s, 1) * shifted(F.lit(total(target)), buckets))
    return both.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).alias("gain"))


def _weight_batches(shared, params: ResamplingParams):
    def run(batches):
        vocabulary, gain = shared.value
        for batch in batches:
            for a, b, features in _slices_of(batch, 1):
                n, weight = np.zeros(b - a, np.int64), np.zeros(b - a, np.int64)
                for buckets, doc in feature_buckets(features, vocabulary, params.longest):
                    n += np.bincount(doc, minlength=b - a)
                    sums = np.concatenate([[0], np.cumsum(gain[buckets])])
                    ends = np.searchsorted(doc, np.arange(b - a + 1))
                    weight += sums[ends[1:]] - sums[ends[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(features.first)),
                     pa.array(n), pa.array(weight)],
                    ["doc_id", "n_words", "n_features", "weight"])
    return run


def noise(seed: str, doc_id="doc_id"):
    """Gumbel noise of an id in thousandths, rounded down, from the first 32 bits of a sha256."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    first = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    uniform = (first.cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform)))


def resample(docs: DataFrame, target: DataFrame,
             params: ResamplingParams = ResamplingParams()) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` for every row of ``docs(doc_id, text)``.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased; ``target(text)``
    holds the texts that the draw should resemble. Of the N documents with ``min_words`` words or
    more, the ``percent * N // 100`` highest scores have a rank, from 1 on; ties go to the smaller
    doc_id.

    Null or empty text: no features, weight 0, never drawn unless ``min_words`` is 0. A null
    doc_id has the noise of the empty text and comes last among equal scores. Repeated rows are
    documents each, with one score. Without target texts the gains compare with an even spread.
    Empty documents give an empty result; extra columns are ignored.
    """
    spark = docs.sparkSession
    ship_code(spark)
    docs, target = only(docs, doc_id="long", text="string"), only(target, text="string")
    texts = docs.select("text")
    vocabulary = learn_vocabulary(texts, params)
    shared = spark.sparkContext.broadcast(vocabulary)
    totals = [written(bucket_totals(t, shared, params), "totals", True) for t in (texts, target)]
    # One number per bucket, however large the corpus.
    gain = np.zeros(params.buckets, np.int64)
    for row in gains(*totals, params.buckets).collect():
        gain[row["bucket"]] = row["gain"]
    weighted = docs.mapInArrow(
        _weight_batches(spark.sparkContext.broadcast((vocabulary, gain)), params),
        "doc_id long, n_words long, n_features long, weight long")
    scored = weighted.withColumn("score", F.col("weight") + noise(params.seed)).withColumn(
        "able", F.col("n_words") >= params.min_words)
    placed = ranked(scored, [F.col("able").desc(), F.col("score").desc(),
                             F.col("doc_id").asc_nulls_last()], "scores")
    able = placed.agg(F.count_if("able").alias("n")).first()["n"]
    drawn = params.percent * able // 100
    return placed.select(
        "doc_id", "n_features", "weight", "score",
        F.when(F.col("rank") < drawn, F.col("rank") + 1).alias("rank"))
