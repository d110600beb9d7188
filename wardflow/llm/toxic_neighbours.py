"""Toxicity from the nearest labelled examples, by exact TF-IDF cosine over a block-max index.

Examples are a bounded sample of the labelled rows that may be learned from; of those with one
label and the same four min-hashes of 5-word shingles one stays. Documents and examples are TF-IDF
vectors over all words of the sample. Words whose presence goes with the label beyond chance
(Chernoff bound of the binomial tail, corrected for the number of words) weigh ``emphasis`` times
as much, in both; near copies within a label count once towards that.

The index holds postings by example, in blocks of consecutive examples. Words in more than an
eighth of the examples, which make most of the postings, are kept dense with the largest weight of
every block, and examples alike in them share blocks. The lists of rarer words have hardly more than one posting in a block, which is then
the block's largest weight, so they are added up as they are. A query bounds each block's best
cosine by the two, visits blocks from the highest bound down, and stops when no bound reaches the
k-th best cosine found: the k nearest are exact. Neighbours vote with weights that fall with their
distance; the vote is calibrated by isotonic regression on the examples themselves, each judged
without itself. The nearest examples are returned as evidence.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow.dataset import dataset
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm import textscan
from wardflow.llm.common import (
    file_system,
    only,
    scratch_path,
    ship_code,
    slices,
    text_buffers,
    written,
)

MIN_HASHES = 4
PIECE = 8 << 20  # bytes of a row that holds a part of the pickled model
MIN_HASH_COLUMNS = [f"least{i}" for i in range(MIN_HASHES)]


@dataclass(frozen=True)
class ToxicityParams:
    max_examples: int = 20_000  # bound of the sample of labelled rows that is learned from
    chance: float = 0.01  # probability that any term is selected by chance
    min_examples_with_term: int = 3
    neighbours: int = 25
    block: int = 64
    softness: float = 0.05  # a neighbour at distance d votes with 1 / (d + softness)
    emphasis: float = 10.0  # weight of terms that go with the label, against others


def held_out(doc_id="doc_id"):
    """Rows whose label is never learned from: crc32 of the id as text divisible by 5."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _example_batches(batches):
    """Terms, counts, and the min-hashes of each labelled document."""
    for batch in batches:
        data, offsets = text_buffers(batch.column(2))
        for a, b in slices(offsets):
            words = textscan.scan(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a],
                                  textscan.letter_table())
            terms, counts, least = [], [], [[] for _ in range(MIN_HASHES)]
            for lo, hi in zip(words.first[:-1], words.first[1:]):
                own = words.hash[lo:hi]
                t, c = np.unique(own, return_counts=True)
                terms.append(t.view(np.int64))
                counts.append(c)
                shingles = textscan.shingle_set(own, 5)
                for i, column in enumerate(least):
                    column.append(int(textscan.mix(shingles, 900 + i).min().view(np.int64))
                                  if len(shingles) else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                 pa.array(terms, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int64())),
                 *[pa.array(column, pa.int64()) for column in least]],
                ["doc_id", "toxic", "terms", "counts", *MIN_HASH_COLUMNS])


def examples(docs: DataFrame, labels: DataFrame, params: ToxicityParams) -> DataFrame:
    """The labelled documents that are learned from; at most ``max_examples`` rows."""
    usable = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out()) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.max_examples)
    # Bounded by max_examples rows of two numbers.
    rows = docs.join(F.broadcast(written(chosen, "chosen")), "doc_id").select(
        "doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"), "text")
    terms = written(rows.mapInArrow(
        _example_batches, "doc_id long, toxic int, terms array<long>, counts array<long>, "
        + ", ".join(f"{c} long" for c in MIN_HASH_COLUMNS)), "examples")
    thinned = terms.dropDuplicates(["doc_id"]).withColumn("_place", F.row_number().over(
        Window.partitionBy("toxic", *MIN_HASH_COLUMNS).orderBy("doc_id"))) \
        .where("_place = 1").drop("_place")
    # Of near copies within a label the first counts. A group is a part of the sample.
    left = thinned.select("doc_id", "toxic", *MIN_HASH_COLUMNS)
    for column in MIN_HASH_COLUMNS:
        place = F.row_number().over(Window.partitionBy("toxic", column).orderBy("doc_id"))
        left = left.withColumn("_place", place).where("_place = 1").drop("_place")
    counted = left.select("doc_id", F.lit(True).alias("counted"))
    return written(thinned.join(counted, "doc_id", "left").select(
        "doc_id", "toxic", "terms", "counts", F.coalesce("counted", F.lit(False)).alias("counted")),
        "thinned")


def select_terms(chosen: DataFrame, params: ToxicityParams) -> list[int]:
    """Terms that go with the label."""
    chosen = chosen.where("counted")
    total = chosen.agg(F.count("toxic").alias("n"), F.sum("toxic").alias("t")).first()
    n, t = total["n"], total["t"] or 0
    if not t or t == n:
        return []
    seen = written(chosen.select(F.explode("terms").alias("term"), "toxic").groupBy("term").agg(
        F.count("toxic").alias("df"), F.sum("toxic").alias("a"))
        .where(F.col("df") >= params.min_examples_with_term), "terms")
    share = F.col("a") / F.col("df")

    def divergence(x, y: float):
        return F.when(x > 0, x * F.log(x / F.lit(y))).otherwise(0.0)

    bound = -F.col("df") * (divergence(share, t / n) + divergence(1 - share, 1 - t / n))
    kept = seen.where(bound <= math.log(params.chance / max(1, seen.count())))
    # Terms of the bounded sample; those beyond chance are few.
    return [r["term"] for r in kept.select("term").orderBy("term").collect()]


class BlockMaxIndex:
    """Exact k nearest examples by cosine over sparse unit vectors.

    A vector is a dictionary of weights by term, or an array of terms and one of their weights.
    """

    FREQUENT = 8  # lists longer than the examples divided by this are dense

    def __init__(self, vectors: list, n_terms: int, block: int):
        self.n, self.block = len(vectors), block
        self.blocks = -(-self.n // block) if self.n else 0
        vectors = [_arrays(v) for v in vectors]
        example = np.repeat(np.arange(self.n, dtype=np.int32), [len(t) for t, _ in vectors])
        terms = np.concatenate([t for t, _ in vectors]) if self.n else np.zeros(0, np.int64)
        weights = np.concatenate([w for _, w in vectors]) if self.n else np.zeros(0)
        df = np.bincount(terms, minlength=n_terms)
        frequent = np.flatnonzero(df * self.FREQUENT > self.n)
        self.dense = np.full(n_terms, -1, np.int32)  # column of a frequent term
        self.dense[frequent] = np.arange(len(frequent))
        column = self.dense[terms]
        rows = np.zeros((self.n, len(frequent)))
        rows[example[column >= 0], column[column >= 0]] = weights[column >= 0]
        self.number = clustered(rows, block)  # example by position in the index
        position = np.empty(self.n, np.int32)
        position[self.number] = np.arange(self.n, dtype=np.int32)
        self.rows = np.zeros((self.blocks * block, len(frequent)))
        self.rows[:self.n] = rows[self.number]
        self.rows = self.rows.reshape(self.blocks, block, len(frequent))
        self.best = self.rows.max(axis=1) if self.n else np.zeros((0, len(frequent)))
        self.number = np.concatenate([self.number, np.full(self.blocks * block - self.n, -1)])
        rare = np.flatnonzero(column < 0)
        rare = rare[np.argsort(terms[rare], kind="stable")]
        self.at, self.weight = position[example[rare]], weights[rare]
        self.first = np.searchsorted(terms[rare], np.arange(n_terms + 1))

    def search(self, query, k: int, without: int = -1):
        """``(example, cosine)`` of the k nearest, higher first, then by example number.

        Examples that share no term with the query have cosine 0 and are not neighbours.
        """
        terms, weights = _arrays(query)
        if not len(terms) or not self.n:
            return []
        column = self.dense[terms]
        dense = np.zeros(self.best.shape[1])
        dense[column[column >= 0]] = weights[column >= 0]
        terms, weights = terms[column < 0], weights[column < 0]
        size = self.first[terms + 1] - self.first[terms]
        ends = np.cumsum(size)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(
            self.first[terms] - ends + size, size)
        partial = np.bincount(self.at[place], self.weight[place] * np.repeat(weights, size),
                              minlength=self.blocks * self.block).reshape(self.blocks, self.block)
        bound = partial.max(axis=1) + self.best @ dense
        order = np.argsort(-bound, kind="stable")
        found, scores = np.zeros(0, np.int64), np.zeros(0)
        begin, step, floor = 0, 8, 0.0
        while begin < self.blocks:
            blocks = order[begin:begin + step]
            # Bounds and scores add up the same products in different orders.
            blocks = blocks[(bound[blocks] > 0) & (bound[blocks] >= floor - 1e-8)]
            if not len(blocks):
                break
            # Block by block, since picking several would copy them.
            common = np.array([self.rows[b] @ dense for b in blocks])
            exact = np.round(partial[blocks] + common, 9).ravel()
            number = self.number.reshape(self.blocks, self.block)[blocks].ravel()
            good = (exact > 0) & (exact >= floor) & (number != without)
            found = np.concatenate([found, number[good]])
            scores = np.concatenate([scores, exact[good]])
            best = np.lexsort((found, -scores))[:k]
            found, scores = found[best], scores[best]
            floor = scores[-1] if len(found) == k else 0.0
            begin, step = begin + step, step * 2
        return list(zip(found.tolist(), scores.tolist()))


def clustered(rows: np.ndarray, block: int) -> np.ndarray:
    """An order in which examples alike in frequent terms are near each other.

    Halved again and again along the direction of largest variance, down to one block; blocks of
    like examples have low bounds for unlike queries. Any order gives the same neighbours.
    """
    done, todo = [], [np.arange(len(rows))]
    while todo:
        part = todo.pop()
        if len(part) <= block or not rows.shape[1]:
            done.append(part)
            continue
        own = rows[part] - rows[part].mean(axis=0)
        axis = np.linalg.eigh(own.T @ own)[1][:, -1]
        part = part[np.argsort(own @ axis, kind="stable")]
        half = max(1, len(part) // 2 // block) * block
        todo += [part[half:], part[:half]]
    return np.concatenate(done)


def _arrays(vector) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(vector, dict):
        return np.array(list(vector), np.int64), np.array(list(vector.values()), np.float64)
    return vector


class Model:
    """Vocabulary, index and labels; all of it bounded by the example sample.

    ``rows`` is a table of ``doc_id, toxic, terms, counts`` by doc_id, ``selected`` the terms that
    are emphasised.
    """

    def __init__(self, rows: pa.Table, selected: list[int], params: ToxicityParams):
        self.params = params
        rows = rows.combine_chunks()
        self.ids = rows["doc_id"].to_numpy()
        self.labels = rows["toxic"].to_numpy().astype(np.int64)
        lists = [rows[name].combine_chunks() for name in ("terms", "counts")]
        terms, counts = (c.flatten().to_numpy(zero_copy_only=False) for c in lists)
        bounds = np.concatenate([[0], np.cumsum(lists[0].value_lengths().to_numpy())]).astype(int)
        terms = terms.astype(np.int64).view(np.uint64)
        self.terms, df = np.unique(terms, return_counts=True)
        self.weights = np.log((1 + len(self.ids)) / (1 + df)) + 1
        self.weights[np.isin(self.terms, np.array(selected, np.int64).view(np.uint64))] *= \
            params.emphasis
        vectors = [self.vector(terms[a:z], counts[a:z]) for a, z in zip(bounds[:-1], bounds[1:])]
        self.index = BlockMaxIndex(vectors, len(self.terms), params.block)
        self.without = self._rate(self.labels[np.diff(bounds) == 0])
        self.cache: dict[tuple, tuple] = {}

    def _rate(self, labels: np.ndarray) -> float:
        return float((labels.sum() + 0.5) / (len(labels) + 1 + 4 * (len(labels) == 0)))

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The unit TF-IDF vector of distinct terms over the vocabulary."""
        if not len(self.terms) or not len(terms):
            return np.zeros(0, np.int64), np.zeros(0)
        place = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        known = self.terms[place] == terms
        place, counts = place[known], counts[known]
        weight = (1 + np.log(counts)) * self.weights[place]
        return place, weight / np.sqrt((weight * weight).sum()) if len(weight) else weight

    def vote(self, found: list[tuple[int, float]]) -> float:
        if not found:
            return 0.0
        weight = np.array([1 / (max(0.0, 1 - s) + self.params.softness) for _, s in found])
        return float((weight * self.labels[[i for i, _ in found]]).sum() / weight.sum())

    def own_vote(self, doc_id: int, terms: np.ndarray, counts: np.ndarray) -> float:
        """The vote on an example by all others."""
        return self.vote(self.index.search(self.vector(terms, counts), self.params.neighbours,
                                           without=int(np.searchsorted(self.ids, doc_id))))

    def judge(self, terms: np.ndarray, counts: np.ndarray) -> tuple[float | None, list, list]:
        """Vote, nearest example ids and their cosines; no vote if the vector is empty."""
        key = (terms.tobytes(), counts.tobytes())
        if key not in self.cache:
            query = self.vector(terms, counts)
            found = self.index.search(query, self.params.neighbours)
            made = (self.vote(found) if len(query[0]) else None,
                    [int(self.ids[i]) for i, _ in found[:3]], [s for _, s in found[:3]])
            if len(self.cache) >= 20_000:
                self.cache.clear()
            self.cache[key] = made
        return self.cache[key]


def isotonic(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the non-decreasing step function nearest to the labels."""
    if not len(votes):
        return np.zeros(0), np.zeros(0)
    order = np.argsort(votes, kind="stable")
    groups: list[list[float]] = []  # begin, sum, size
    for v, y in zip(votes[order], labels[order]):
        if groups and groups[-1][0] == v:
            groups[-1][1] += y
            groups[-1][2] += 1
        else:
            groups.append([float(v), float(y), 1.0])
        while len(groups) > 1 and groups[-2][1] * groups[-1][2] >= groups[-1][1] * groups[-2][2]:
            last = groups.pop()
            groups[-1][1] += last[1]
            groups[-1][2] += last[2]
    return (np.array([g[0] for g in groups]),
            np.array([(g[1] + 0.5) / (g[2] + 1) for g in groups]))


def _own_votes(shared):
    def run(batches):
        for batch in batches:
            votes = [shared.value.own_vote(i, np.array(t, np.int64).view(np.uint64),
                                           np.array(c, np.int64))
                     for i, t, c in zip(*[batch.column(k).to_pylist() for k in (0, 2, 3)])]
            yield pa.RecordBatch.from_arrays([pa.array(votes, pa.float64()), batch.column(1)],
                                             ["vote", "toxic"])
    return run


def _score_batches(shared, steps: np.ndarray, values: np.ndarray):
    def score(model: Model, vote: float | None) -> float:
        if vote is None or not len(steps):
            return model.without
        return float(values[max(0, np.searchsorted(steps, vote + 1e-12, side="right") - 1)])

    def run(batches):
        model: Model = shared.value
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for a, b in slices(offsets):
                words = textscan.scan(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a],
                                      textscan.letter_table())
                out = [model.judge(*np.unique(words.hash[lo:hi], return_counts=True))
                       for lo, hi in zip(words.first[:-1], words.first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a),
                     pa.array([score(model, v) for v, _, _ in out]),
                     pa.array([e for _, e, _ in out], pa.list_(pa.int64())),
                     pa.array([c for _, _, c in out], pa.list_(pa.float64()))],
                    ["doc_id", "score", "nearest", "cosines"])
    return run


def _model_batches(selected: list[int], params: ToxicityParams):
    """The model of all rows of the one partition, pickled, in pieces."""
    def run(batches):
        rows = [b for b in batches if b.num_rows]
        if rows:
            whole = pickle.dumps(Model(pa.Table.from_batches(rows), selected, params), protocol=5)
            for number, first in enumerate(range(0, len(whole), PIECE)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([whole[first:first + PIECE]], pa.binary())],
                    ["number", "piece"])
    return run


class StoredModel:
    """A model in the shared folder; each Python worker reads it once."""

    _loaded: tuple[str, Model] | None = None

    def __init__(self, path: str, params: ToxicityParams):
        self.path, self.params = path, params

    @property
    def value(self) -> Model:
        if StoredModel._loaded is None or StoredModel._loaded[0] != self.path:
            system, path = file_system(self.path)
            pieces = dataset(path, filesystem=system, format="parquet",
                             schema=pa.schema([("number", pa.int64()), ("piece", pa.binary())])
                             ).to_table().sort_by("number")["piece"]
            made = pickle.loads(b"".join(p.as_buffer() for p in pieces)) if len(pieces) else \
                Model(pa.table({"doc_id": pa.array([], pa.int64()),
                                "toxic": pa.array([], pa.int32()),
                                "terms": pa.array([], pa.list_(pa.int64())),
                                "counts": pa.array([], pa.list_(pa.int64()))}), [], self.params)
            StoredModel._loaded = self.path, made
        return StoredModel._loaded[1]


def learn(chosen: DataFrame, params: ToxicityParams) -> StoredModel:
    """Built by one task, from at most ``max_examples`` rows; neither it nor they reach the driver."""
    rows = chosen.select("doc_id", "toxic", "terms", "counts").repartition(1) \
        .sortWithinPartitions("doc_id")
    pieces = rows.mapInArrow(_model_batches(select_terms(chosen, params), params),
                             "number long, piece binary")
    path = scratch_path(chosen.sparkSession, "toxicity-model")
    pieces.write.parquet(path)
    return StoredModel(path, params)


def score_toxicity(docs: DataFrame, labels: DataFrame,
                   params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """``doc_id, held_out, score, predicted, nearest, cosines`` for every row of ``docs``.

    ``docs(doc_id, text)``, ``labels(doc_id, toxic)``. ``score`` is calibrated to the rate of the
    label among examples; a text without any word of the sample, such as a null or empty one, gets
    the rate of the examples without words. ``predicted`` is 1 from a score of 0.5 on.

    Labels that are null or have a null id are not learned from; of a doc_id with several labels
    the largest counts. Without labels of both kinds the score is a prior of 0.1. Null doc_id:
    scored, and held out. Repeated rows are returned each; empty documents give an empty result.
    Extra columns are ignored.
    """
    spark = docs.sparkSession
    ship_code(spark)
    docs = only(docs, doc_id="long", text="string")
    chosen = examples(docs, only(labels, doc_id="long", toxic="int"), params)
    model = learn(chosen, params)
    # Two numbers for each of at most max_examples rows.
    votes = chosen.where(F.size("terms") > 0).select("doc_id", "toxic", "terms", "counts") \
        .repartition(spark.sparkContext.defaultParallelism) \
        .mapInArrow(_own_votes(model), "vote double, toxic int").toArrow()
    steps, values = isotonic(votes["vote"].to_numpy(), votes["toxic"].to_numpy())
    scored = docs.mapInArrow(
        _score_batches(model, steps, values),
        "doc_id long, score double, nearest array<long>, cosines array<double>")
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         "nearest", "cosines")
