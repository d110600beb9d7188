"""Exact Jaccard join of shingle sets, size-aware: subsets for light sets, lists for heavy ones.

Two sets of sizes a and b are linked when they share ``required(a, b)`` shingles. Equal sets are
one class from the start.

Light sets, up to a size x, enumerate their subsets of fixed sizes: for every size b that a
partner may have, all subsets of ``required(a, b)`` shingles. Two sets are linked if and only if
they have such a subset in common, so nothing is verified. The members of a subset's group are
linked to one of them, never to each other.

Heavy sets are found by inverted lists. Shingles have one global order, by hash; a set puts its
first ``n - required + k`` into the lists, and linked sets share ``k`` of those, because at most
``n - required`` of a set's shingles are not shared. So a set is out unless that many of its
entries are in lists of two or more, and pairs are compared on whole sets only if they meet in as
many lists. Classes are first joined to one center per list, so that lists full of near copies
become one component; then only lists that still hold several components are scanned, pair by
pair between small components, in blocks against large ones. No partner is left out.

The boundary x is where the work is least: subsets to enumerate up to x against list entries to
read beyond it, both counted on the data. Light sets that may be linked with heavy ones, from
nine tenths of x on at 90 percent, are in the lists as well.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm import textscan
from wardflow.llm.common import only, ship_code, slices, text_buffers, written
from wardflow.llm.components import components
from wardflow.llm.minhash_dedup import (LARGE, _able, _fits, _labelled, _large_links, _mixed,
                                        _same_id_links, _set_batches, _star_pairs, _verified)


@dataclass(frozen=True)
class JoinParams:
    shingle: int = 3
    percent: int = 90
    extra_percent: int = 10  # k, in percent of a set's size
    most_light: int = 27  # the boundary is at most this; beyond it subsets run into thousands

    def required(self, a: int, b: int) -> int:
        """Shingles that sets of these sizes share if they are linked."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def partners(self, n: int) -> range:
        """Sizes that a set linked with one of ``n`` can have."""
        return range(-(-self.percent * n // 100), 100 * n // self.percent + 1)

    def subset_sizes(self, n: int) -> list[tuple[int, int, int]]:
        """``(smaller, larger, subset)`` for every partner size; equal sets are one class."""
        out = []
        for b in self.partners(n):
            c = self.required(n, b)
            if c < n or b > n:
                out.append((min(n, b), max(n, b), c))
        return out

    def subsets(self, n: int) -> int:
        return sum(comb(n, c) for _, _, c in self.subset_sizes(n))

    def extra(self, n: int) -> int:
        return max(1, n * self.extra_percent // 100)

    def listed(self, n: int) -> int:
        """Length of the prefix that is put into the lists."""
        return min(n, n - -(-self.percent * n // 100) + self.extra(n))

    def meetings(self, smaller: Column) -> Column:
        """Lists in which two linked sets meet at least; ``smaller`` is the smaller size."""
        return F.greatest(F.lit(1), F.floor(smaller * self.extra_percent / F.lit(100)))


def _sets(data, offsets, shingle):
    words = textscan.scan(data, offsets, textscan.space_table(True))
    return [textscan.shingle_set(words.hash[a:b], shingle)
            for a, b in zip(words.first[:-1], words.first[1:])]


def prefix(shingles: np.ndarray, length: int) -> np.ndarray:
    """The first shingles in the global order."""
    if length >= len(shingles):
        return shingles
    return shingles[np.argpartition(textscan.mix(shingles, 61), length - 1)[:length]]


def _lists(parts: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate([*parts, np.zeros(0, np.uint64)]).astype(np.uint64)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat.view(np.int64)))


def _described_batches(params: JoinParams):
    """Size, two digests and list entries of each set; the whole set where it may be light."""
    none = np.zeros(0, np.uint64)

    def run(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for a, b in slices(offsets):
                sets = _sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a],
                             params.shingle)
                digests = [pa.array(np.array([textscan.mix(s, seed).sum(dtype=np.uint64)
                                              for s in sets], np.uint64).view(np.int64))
                           for seed in (31, 37)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()),
                     *digests, _lists([prefix(s, params.listed(len(s))) for s in sets]),
                     _lists([s if len(s) <= params.most_light else none for s in sets])],
                    ["doc_id", "n", "h1", "h2", "keys", "light"])
    return run


# --- light sets ----------------------------------------------------------


@lru_cache(maxsize=256)
def _left_out(n: int, c: int) -> np.ndarray:
    return np.array(list(combinations(range(n), n - c)), np.int64).reshape(comb(n, c), n - c)


def subset_keys(shingles: np.ndarray, c: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums for every subset of ``c`` shingles: all of them less those left out."""
    out = []
    for seed in (31, 37):
        value = textscan.mix(shingles, seed)
        out.append(value.sum(dtype=np.uint64)
                   - value[_left_out(len(shingles), c)].sum(axis=1, dtype=np.uint64))
    return out[0], out[1]


def _subset_batches(params: JoinParams):
    def run(batches):
        for batch in batches:
            reps = batch.column(0).to_numpy()
            for rep, shingles in zip(reps, batch.column(1)):
                own = np.array(shingles.as_py(), np.int64).view(np.uint64)
                for low, high, c in params.subset_sizes(len(own)):
                    k1, k2 = subset_keys(own, c)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(k1), v)) for v in (int(rep), len(own), low, high)]
                        + [pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64))],
                        ["rep", "n", "low", "high", "k1", "k2"])
    return run


def light_links(light: DataFrame, params: JoinParams) -> DataFrame:
    """Links between the sets of ``light(rep, shingles)``, by common subsets."""
    entries = written(light.mapInArrow(
        _subset_batches(params), "rep long, n long, low long, high long, k1 long, k2 long"),
        "subsets", True)
    key = ["low", "high", "k1", "k2"]
    # Members of the smaller size are linked with all of their group, the larger ones need not
    # be with each other: they have a group of their own size for that.
    centers = written(entries.where("n = low").groupBy(*key).agg(F.min("rep").alias("center")),
                      "subset-centers", True)
    return entries.join(centers, key).where("rep <> center").select(
        F.col("center").alias("a"), F.col("rep").alias("b")).distinct()


# --- heavy sets ----------------------------------------------------------


def boundary(reps: DataFrame, entries: DataFrame, params: JoinParams) -> int:
    """The size up to which enumerating subsets is less work than reading the sets' lists.

    ``entries(key, rep, n, m)``, ``m`` being the length of the entry's list.
    """
    small = F.col("n") <= params.most_light
    # One row per size up to most_light.
    sets = {r["n"]: r["c"] for r in reps.where(small).groupBy("n").agg(
        F.count("n").alias("c")).collect()}
    reads = {r["n"]: r["c"] for r in entries.where(small).groupBy("n").agg(
        F.sum("m").alias("c")).collect()}
    sizes = range(1, params.most_light + 1)
    work = {x: sum(sets.get(n, 0) * params.subsets(n) for n in sizes if n <= x)
            + sum(reads.get(n, 0) for n in sizes if n >= params.partners(x + 1)[0])
            for x in range(params.most_light + 1)}
    return min(work, key=lambda x: (work[x], x))


def _meeting_pairs(entries: DataFrame, params: JoinParams) -> DataFrame:
    """Pairs of classes of different small components that meet in enough lists."""
    small = written(entries.where(F.col("size") < LARGE).select(
        "key", "rep", "n", "component", "u"), "small")
    sides = [small.select("key", *[F.col(c).alias(f"{c}{i}") for c in small.columns[1:]])
             for i in (1, 2)]
    least, most = F.least("u1", "u2"), F.col("n1") + F.col("n2")
    met = sides[0].join(
        sides[1].withColumnRenamed("key", "key2"),
        (F.col("key") == F.col("key2")) & (F.col("rep1") < F.col("rep2"))
        & (F.col("component1") != F.col("component2"))
        & (least * 100 >= (most - least) * params.percent)
        & (F.least("n1", "n2") * 100 >= F.greatest("n1", "n2") * params.percent))
    return met.groupBy(F.col("rep1").alias("a"), F.col("rep2").alias("b"),
                       F.least("n1", "n2").alias("n")).agg(F.count("n1").alias("met")).where(
        F.col("met") >= params.meetings(F.col("n"))).select("a", "b")


def _promising(pairs: DataFrame, params: JoinParams) -> DataFrame:
    """Centers that a class meets often. What is left out here is still scanned later."""
    counted = pairs.where(_fits(params.percent)).groupBy(
        "a", "b", F.least("na", "nb").alias("n")).agg(F.count("na").alias("met"))
    return counted.where(F.col("met") * 2 >= params.meetings(F.col("n"))).select("a", "b")


def join_sets(docs: DataFrame, params: JoinParams = JoinParams()) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs(doc_id, text)``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z folded; a document is the set of its distinct
    ``shingle``-word runs, all its words as one run when it has fewer. Documents whose sets have
    ``100 * intersection >= percent * union`` are linked; ``component_id`` is the smallest doc_id
    reachable.

    Null or empty text, or white space only: size 0, linked with nothing. A repeated doc_id: each
    row is returned, and all of them share the component of the id. A null doc_id is linked with
    nothing and has a null component. An empty table gives an empty result. Extra columns are
    ignored.
    """
    ship_code(docs.sparkSession)
    docs = only(docs, doc_id="long", text="string")
    described = written(docs.mapInArrow(
        _described_batches(params), "doc_id long, n long, h1 long, h2 long, keys array<long>, "
        "light array<long>"), "described")

    # Classes of equal sets. The empty set links nothing; a null id has no place in a class.
    full = described.where("n > 0 AND doc_id IS NOT NULL")
    classes = written(full.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep")),
                      "classes", True)
    reps = written(full.join(classes.select("h1", "h2", "n", F.col("rep").alias("doc_id")),
                             ["doc_id", "h1", "h2", "n"], "left_semi")
                   .dropDuplicates(["doc_id", "h1", "h2"]).select("doc_id", "n", "keys", "light"),
                   "reps")
    entries = reps.select(F.explode("keys").alias("key"), F.col("doc_id").alias("rep"), "n")
    lengths = written(entries.groupBy("key").agg(F.count("rep").alias("m")).where("m > 1"),
                      "lengths", True)
    listed = written(entries.join(lengths, "key"), "lists")

    x = boundary(reps, listed, params)
    light = reps.where(F.col("n") <= x).select(
        F.col("doc_id").alias("rep"), F.col("light").alias("shingles"))
    links = written(_same_id_links(full, classes).union(light_links(light, params)), "links", True)
    labels = written(components(links), "components", True)

    # Sets of which too few entries are in lists of two or more have no partner.
    heavy = listed.where(F.col("n") >= params.partners(x + 1)[0]).select("key", "rep", "n")
    met = written(heavy.groupBy("rep", "n").agg(F.count("key").alias("met")).where(
        F.col("met") >= params.meetings(F.ceil(F.col("n") * params.percent / F.lit(100)))),
        "met", True)
    crowded = written(heavy.join(met.select("rep"), "rep", "left_semi"), "crowded")
    mixed = _mixed(crowded, labels)
    if mixed.isEmpty():
        return _result(described, classes, labels)
    wanted = docs.join(written(mixed.select(F.col("rep").alias("doc_id")).distinct(), "ids", True),
                       "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    sets = written(wanted.mapInArrow(_set_batches(params.shingle),
                                     "doc_id long, shingles array<long>"), "sets")
    tested = written(_promising(_star_pairs(mixed, 0), params), "pairs", True)
    found = written(_verified(tested, sets, params.percent), "verified", True)
    links = links.union(found)
    labels = written(components(links), "components", True)
    mixed = _mixed(crowded, labels)
    if mixed.isEmpty():
        return _result(described, classes, labels)
    able = _able(mixed, sets, params.percent)
    pairs = written(_meeting_pairs(able, params).join(tested, ["a", "b"], "left_anti"),
                    "pairs", True)
    found = written(_verified(pairs, sets, params.percent).union(
        _large_links(able, sets, params.percent)), "verified", True)
    if not found.isEmpty():
        labels = written(components(links.union(found)), "components", True)
    return _result(described, classes, labels)


def _result(described: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    return _labelled(described, classes, labels).drop("kept")
