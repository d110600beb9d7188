"""Near-duplicates by fast similarity sketching, banding and exact verification.

Sketch: ``t`` bins are filled in rounds. In round i < t every shingle falls into the bin that the
round's hash names; in round t + i every shingle falls into bin i. A bin keeps the smallest
(round, hash) that reached it, and a document stops after the first round that leaves no bin
empty, so after at most 2 t rounds every coordinate is filled. Two documents agree in a
coordinate with a probability equal to their Jaccard similarity, with Chernoff-type concentration
of the number of agreeing coordinates, at an expected cost of O(n + t log t).

Banding: ``bands`` of t / bands coordinates. A pair at similarity s shares a band with probability
1 - (1 - s^r)^bands; at 0.8 and 32 bands of 4, all but 5e-8 of the pairs do.

Candidates: documents with equal shingle sets are one class. Every band bucket first links its
classes to one of them (a star), verified on whole sets. Then only buckets that still hold
classes of different components matter; with ``star_rounds`` above 1 the star is repeated there
around other centers. What is left is checked without a cap on partners: pairs between small
components one by one, and classes outside a large component against that component in blocks, so
that a large group of near copies is never expanded into pairs. A proven bound thins this out: only shingles that two or more of the
remaining classes have can be common to a pair, so with u and v of those in sets of sizes a and b
the similarity is at most m / (a + b - m) for m = min(u, v).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm import textscan
from wardflow.llm.common import only, ship_code, slices, text_buffers, written
from wardflow.llm.components import components

ROUND_SHIFT = np.uint64(56)
#: From this size on a component is compared in blocks, below it pair by pair; both are exact.
LARGE = 32
#: Sides of a block.
MEMBERS, QUERIES = 1024, 4096


@dataclass(frozen=True)
class NearDupParams:
    shingle: int = 5
    percent: int = 80
    coordinates: int = 128
    bands: int = 32
    star_rounds: int = 1


def sketch(sets: list[np.ndarray], t: int) -> np.ndarray:
    """Fast similarity sketches, one row of ``t`` filled coordinates per nonempty shingle set."""
    n = len(sets)
    table = np.full(n * t, np.uint64(0xFFFFFFFFFFFFFFFF))
    doc = np.repeat(np.arange(n, dtype=np.int64), [len(s) for s in sets])
    items = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    for turn in range(2 * t):
        h = textscan.mix(items, 7000 + turn)
        value = (h >> np.uint64(8)) + (np.uint64(min(turn, 255)) << ROUND_SHIFT)
        if turn < t:
            # The bin comes from a second mixing, so that bin and value are independent.
            place = (textscan.mix(h, 3) % np.uint64(t)).astype(np.int64)
        else:
            place = np.full(len(h), turn - t, np.int64)
        np.minimum.at(table, doc * t + place, value)
        full = (table.reshape(n, t) != np.uint64(0xFFFFFFFFFFFFFFFF)).all(axis=1)
        if full.all():
            break
        keep = ~full[doc]
        doc, items = doc[keep], items[keep]
    return table.reshape(n, t)


def band_keys(table: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per document and band; keys of different bands do not meet."""
    n, t = table.shape
    rows = t // bands
    part = table.reshape(n, bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (n, bands)).copy()
    for j in range(rows):
        key = textscan.mix(key * np.uint64(0xD6E8FEB86659FD93) + part[:, :, j], 23)
    return key


def _sets(data, offsets, shingle):
    words = textscan.scan(data, offsets, textscan.space_table(True))
    return [textscan.shingle_set(words.hash[a:b], shingle)
            for a, b in zip(words.first[:-1], words.first[1:])]


def _sketch_batches(params: NearDupParams):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            data, offsets = text_buffers(batch.column(1))
            for a, b in slices(offsets):
                sets = _sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a],
                             params.shingle)
                sizes = np.array([len(s) for s in sets], np.int64)
                some = np.flatnonzero(sizes)
                one, two = np.zeros(b - a, np.uint64), np.zeros(b - a, np.uint64)
                for i in some:
                    one[i] = textscan.mix(sets[i], 31).sum(dtype=np.uint64)
                    two[i] = textscan.mix(sets[i], 37).sum(dtype=np.uint64)
                keys = np.zeros((0, params.bands), np.uint64)
                if len(some):
                    keys = band_keys(sketch([sets[i] for i in some], params.coordinates),
                                     params.bands)
                lengths = np.where(sizes > 0, params.bands, 0)
                bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(sizes), pa.array(one.view(np.int64)),
                     pa.array(two.view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(bounds),
                                              pa.array(keys.reshape(-1).view(np.int64)))],
                    ["doc_id", "n", "h1", "h2", "bands"])
    return run


def _set_batches(shingle: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            data, offsets = text_buffers(batch.column(1))
            for a, b in slices(offsets):
                sets = _sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], shingle)
                bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.ListArray.from_arrays(
                        pa.array(bounds), pa.array(np.concatenate(sets).view(np.int64)))],
                    ["doc_id", "shingles"])
    return run


def _fits(percent: int):
    """Sizes alone allow the similarity: the smaller set is at least that share of the larger."""
    return F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar enough.

    Both joins are plain joins of exchanged tables, so a class with very many partners is split.
    """
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.select("a", "b").join(left, "a").join(right, "b")
            .select("a", "b", both.alias("both"),
                    F.size("sa").alias("na"), F.size("sb").alias("nb"))
            .where(F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * percent)
            .select("a", "b"))


def near_duplicates(docs: DataFrame, params: NearDupParams = NearDupParams()) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs(doc_id, text)``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z folded; a document is the set of its distinct
    ``shingle``-word runs, all its words as one run when it has fewer. Documents whose sets have
    ``100 * intersection >= percent * union`` are linked; ``component_id`` is the smallest doc_id
    reachable and ``kept`` marks the document that has it.

    Null or empty text, or white space only: size 0, linked with nothing. A repeated doc_id: each
    row is returned, and all of them share the component of the id. A null doc_id is linked with
    nothing and has a null component; it is kept. An empty table gives an empty result. Extra
    columns are ignored.
    """
    spark = docs.sparkSession
    ship_code(spark)
    docs = only(docs, doc_id="long", text="string")
    sketched = written(docs.mapInArrow(
        _sketch_batches(params),
        "doc_id long, n long, h1 long, h2 long, bands array<long>"), "sketches")

    # Classes of equal sets. The empty set links nothing; a null id has no place in a class.
    full = sketched.where("n > 0 AND doc_id IS NOT NULL")
    classes = written(full.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep")),
                      "classes", True)
    reps = written(full.join(classes.select("h1", "h2", "n", F.col("rep").alias("doc_id")),
                             ["doc_id", "h1", "h2", "n"], "left_semi")
                   .dropDuplicates(["doc_id", "h1", "h2"]).select("doc_id", "n", "bands"), "reps")
    entries = reps.select(F.explode("bands").alias("key"), F.col("doc_id").alias("rep"), "n")
    shared_keys = entries.groupBy("key").agg(F.count("rep").alias("m")).where("m > 1").select("key")
    crowded = written(entries.join(written(shared_keys, "keys", True), "key"), "buckets")

    members = written(crowded.select(F.col("rep").alias("doc_id")).distinct(), "ids", True)
    wanted = docs.join(members, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    sets = written(wanted.mapInArrow(_set_batches(params.shingle),
                                     "doc_id long, shingles array<long>"), "sets")

    links, tested = written(_same_id_links(full, classes), "same-id", True), None
    mixed = crowded.withColumn("component", F.col("rep"))
    for turn in range(params.star_rounds):
        pairs = _star_pairs(mixed, turn).where(_fits(params.percent)).select("a", "b").distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs", True)
        found = written(_verified(pairs, sets, params.percent), "verified", True)
        tested = pairs if tested is None else tested.union(pairs)
        links = links.union(found)
        if turn == 0 or not found.isEmpty():
            labels = written(components(links), "components", True)
            mixed = _mixed(crowded, labels)
        if mixed.isEmpty():
            return _labelled(sketched, classes, labels)
    able = _able(mixed, sets, params.percent)
    pairs = _small_pairs(able, reps, params.percent).where(_fits(params.percent))
    pairs = written(pairs.select("a", "b").join(tested, ["a", "b"], "left_anti"), "pairs", True)
    found = written(_verified(pairs, sets, params.percent).union(
        _large_links(able, sets, params.percent)), "verified", True)
    if not found.isEmpty():
        labels = written(components(links.union(found)), "components", True)
    return _labelled(sketched, classes, labels)


def _same_id_links(full: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes in which a repeated doc_id occurs."""
    repeated = written(full.groupBy("doc_id").agg(
        F.min("h1").alias("lo"), F.max("h1").alias("hi")).where("lo <> hi").select("doc_id"),
        "repeated", True)
    place = full.join(repeated, "doc_id", "left_semi").join(classes, ["h1", "h2", "n"])
    return place.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))


def _star_pairs(entries: DataFrame, turn: int) -> DataFrame:
    """Each bucket's classes with the bucket's center, where the two are not yet connected."""
    order = F.col("rep") if turn == 0 else F.xxhash64(F.lit(turn), "rep")
    center = entries.groupBy("key").agg(
        F.min(F.struct(order.alias("o"), F.col("rep"), F.col("n"), F.col("component"))).alias("c"))
    center = written(center.select("key", F.col("c.rep").alias("c_rep"), F.col("c.n").alias("c_n"),
                                   F.col("c.component").alias("c_component")), "centers", True)
    return (entries.join(center, "key").where("component <> c_component")
            .select(F.least("rep", "c_rep").alias("a"), F.greatest("rep", "c_rep").alias("b"),
                    F.col("n").alias("na"), F.col("c_n").alias("nb")))


def _mixed(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """The entries of buckets that still hold classes of more than one component."""
    labelled = written(
        entries.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("component", F.coalesce("component", "rep")), "labelled", True)
    keys = written(labelled.groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
        .select("key"), "mixed-keys", True)
    return written(labelled.join(keys, "key"), "mixed", True)


def _common_shingles(entries: DataFrame, sets: DataFrame) -> DataFrame:
    """``(rep, u)``: how many shingles of each class some other class of the entries has, too."""
    reps = entries.select(F.col("rep").alias("doc_id")).distinct()
    # A repeated doc_id may have several texts; each counts by itself, and the largest bounds all.
    members = sets.join(written(reps, "remaining", True), "doc_id", "left_semi").withColumn(
        "text", F.xxhash64("shingles"))
    alone = (members.select(F.explode("shingles").alias("s"), "doc_id", "text").groupBy("s")
             .agg(F.count("s").alias("df"), F.min("doc_id").alias("doc_id"),
                  F.min("text").alias("text")).where("df = 1")
             .groupBy("doc_id", "text").agg(F.count("s").alias("alone")))
    size = members.groupBy("doc_id", "text").agg(F.max(F.size("shingles")).alias("size"))
    shared = F.col("size") - F.coalesce("alone", F.lit(0))
    return size.join(alone, ["doc_id", "text"], "left").groupBy(
        F.col("doc_id").alias("rep")).agg(F.max(shared).alias("u"))


def _able(entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The entries of classes that can have a partner at all, with component sizes.

    A class that shares too few of its own shingles with all others together has none.
    """
    common = written(_common_shingles(entries, sets), "common", True)
    able = written(entries.join(common, "rep").where(F.col("u") * 100 >= F.col("n") * percent),
                   "able", True)
    sizes = written(able.select("rep", "component").distinct().groupBy("component")
                    .agg(F.count("rep").alias("size")), "sizes", True)
    return written(able.join(sizes, "component"), "sized", True)


def _small_pairs(able: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs of a bucket from different components of fewer than LARGE classes, not ruled out.

    A pair is taken in the first bucket that its classes share.
    """
    small = written(able.where(F.col("size") < LARGE).join(
        reps.select(F.col("doc_id").alias("rep"), "bands"), "rep"), "small")
    sides = [small.select("key", *[F.col(c).alias(f"{c}{i}") for c in
                                   ("rep", "n", "component", "u", "bands")]) for i in (1, 2)]
    most = F.least("u1", "u2")
    met = sides[0].join(
        sides[1].withColumnRenamed("key", "key2"),
        (F.col("key") == F.col("key2")) & (F.col("rep1") < F.col("rep2"))
        & (F.col("component1") != F.col("component2"))
        & (most * 100 >= (F.col("n1") + F.col("n2") - most) * percent)
        & (F.element_at(F.array_intersect("bands1", "bands2"), 1) == F.col("key")))
    return met.select(F.col("rep1").alias("a"), F.col("rep2").alias("b"),
                      F.col("n1").alias("na"), F.col("n2").alias("nb"))


def _block_links(percent: int):
    def run(members, queries):
        """The first member of the block that each query is similar to."""
        sizes = members["shingles"].map(len).to_numpy()
        items = np.concatenate(list(members["shingles"]))
        owners = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(items, kind="stable")
        items, owners = items[order], owners[order]
        a, b = [], []
        for rep, shingles in zip(queries["rep"], queries["shingles"]):
            low = np.searchsorted(items, shingles, side="left")
            n = np.searchsorted(items, shingles, side="right") - low
            place = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            both = np.bincount(owners[place], minlength=len(sizes))
            near = np.flatnonzero(both * 100 >= (sizes + len(shingles) - both) * percent)
            if len(near):
                other = int(members["rep"].iloc[near[0]])
                a.append(min(int(rep), other))
                b.append(max(int(rep), other))
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    def blocks(key, members, queries):
        if not len(members) or not len(queries):
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        return run(members, queries)
    return blocks


def _large_links(able: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between classes and the components of LARGE or more classes they share a bucket with.

    A class outside is compared with the whole component, in a grid of blocks: MEMBERS classes of
    the component by QUERIES classes outside, so that no task holds more, and no pair becomes a
    row. One link in a block is enough to connect the two.
    """
    targets = able.where(F.col("size") >= LARGE).select(
        "key", F.col("component").alias("target"), F.col("size").alias("target_size")).distinct()
    outside = able.join(written(targets, "targets", True), "key").where(
        (F.col("size") < F.col("target_size"))
        | ((F.col("size") == F.col("target_size")) & (F.col("component") < F.col("target"))))
    queries = written(outside.where("component <> target").select("target", "rep").distinct(),
                      "queries", True)
    grid = written(queries.groupBy("target").agg(F.count("rep").alias("q")).join(
        able.select(F.col("component").alias("target"), "size").distinct(), "target").select(
        "target", F.ceil(F.col("q") / QUERIES).cast("int").alias("columns"),
        F.ceil(F.col("size") / MEMBERS).cast("int").alias("rows")), "grid", True)

    def cell(n: str):
        return F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    shingles = sets.withColumnRenamed("doc_id", "rep")
    members = written(able.select(F.col("component").alias("target"), "rep").distinct().join(
        grid, "target").select("target", "rep", cell("rows").alias("row"),
                               every("columns").alias("column")).join(shingles, "rep"), "members")
    asked = written(queries.join(grid, "target").select(
        "target", "rep", cell("columns").alias("column"), every("rows").alias("row")).join(
        shingles, "rep"), "asked")
    place = ["target", "row", "column"]
    return members.groupBy(*place).cogroup(asked.groupBy(*place)).applyInPandas(
        _block_links(percent), "a long, b long")


def _labelled(sketched: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    final = written(
        classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .select("h1", "h2", "n", F.coalesce("component", "rep").alias("component")), "final", True)
    rows = sketched.select("doc_id", "n", "h1", "h2").join(final, ["h1", "h2", "n"], "left")
    component = F.when((F.col("n") > 0) & F.col("component").isNotNull()
                       & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    return rows.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
