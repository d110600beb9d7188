"""A Merkle manifest of a dataset: one tree per partition value, one over their roots, and proofs.

Leaves are hashes of whole rows. Inside a partition they are numbered in the order of their ids;
while several nodes remain, every ``FANOUT`` consecutive ones become their hash. The roots of the
partitions, in the order of the partition values, are the leaves of a last tree of the same kind.

The log: a builder is one aligned block of ``BLOCK`` leaves, a subtree of ``HEIGHT`` levels whose
nodes no other block shares. It appends every node when its last child is complete, which is
postorder, and its log is one row of the written table. The blocks' roots are the leaves of the
next round, until each tree has one root, so a round is a ``BLOCK``-th of the one before. Within a
round the place of a node follows from subtree sizes alone (``position``): full blocks before its
own, full subtrees before it, and its own descendants. No address is stored.

Proofs go the other way. The path above a block is joined to it, and inside the block the
siblings of every node are read from the log at their computed positions; a leaf's path is its
own siblings followed by the path of its parent. A block is the most that a task holds.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wardflow.llm.common import only, ship_code, written
from wardflow.llm.ordering import ranked

FANOUT = 8
HEIGHT = 3
BLOCK = FANOUT ** HEIGHT
DIGEST = 32

#: The columns of a leaf in their order, with the type they are read as.
LEAF = {"doc_id": "long", "source": "string", "lang": "string", "n_chars": "long",
        "text": "string"}


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


# --- addresses -----------------------------------------------------------


def widths(leaves: int) -> list[int]:
    """Nodes on each level of a block of ``leaves`` leaves that is not the only one of its tree."""
    out = [leaves]
    for _ in range(HEIGHT):
        out.append(-(-out[-1] // FANOUT))
    return out


def levels_of(leaves: int, alone: bool) -> list[int]:
    """Nodes on each level; the only block of a tree ends where one node remains."""
    full = widths(leaves)
    return full[:full.index(1) + 1] if alone else full


def subtree(level: int) -> int:
    """Nodes of a full subtree whose root is on ``level``."""
    return (FANOUT ** (level + 1) - 1) // (FANOUT - 1)


def position(level: int, index: int, leaves: int, top: int) -> int:
    """Postorder place of node ``index`` of ``level`` in a block with ``leaves`` leaves.

    ``top`` is the level of the block's root. Nodes up to its own level are complete if they
    begin before its last leaf ends, nodes above only if they end before its first leaf.
    """
    end = min((index + 1) * FANOUT ** level, leaves)
    upto = sum(-(-end // FANOUT ** k) for k in range(level + 1))
    above = sum(index // FANOUT ** (k - level) for k in range(level + 1, top + 1))
    return upto + above - 1


@lru_cache(maxsize=64)
def positions(leaves: int, alone: bool) -> list[list[int]]:
    sizes = levels_of(leaves, alone)
    return [[position(level, i, leaves, len(sizes) - 1) for i in range(size)]
            for level, size in enumerate(sizes)]


# --- building ------------------------------------------------------------


def append_log(leaves: list[str], alone: bool) -> list[str]:
    """The nodes of a block in the order in which they are complete; the last one is its root."""
    top = len(levels_of(len(leaves), alone)) - 1
    log: list[str] = []
    open_runs: list[list[str]] = [[] for _ in range(top)]

    def add(level: int, node: str) -> None:
        log.append(node)
        if level < top:
            open_runs[level].append(node)
            if len(open_runs[level]) == FANOUT:
                close(level)

    def close(level: int) -> None:
        run, open_runs[level] = open_runs[level], []
        add(level + 1, digest("".join(run)))

    for leaf in leaves:
        add(0, leaf)
    for level in range(top):
        if open_runs[level]:
            close(level)
    return log


_SEGMENT = pa.schema([
    ("tree", pa.int64()), ("n", pa.int64()), ("block", pa.int64()),
    ("ids", pa.list_(pa.int64())), ("altered", pa.list_(pa.binary())), ("log", pa.binary()),
    ("root", pa.binary())])
SEGMENT_DDL = ("tree long, n long, block long, ids array<long>, altered array<binary>, "
               "log binary, root binary")


def _build_batches(batches):
    """Rows sorted by tree and number in, one row per block out."""
    at, n = None, 0
    ids: list = []
    leaves: list[str] = []
    altered: list = []

    def finished():
        log = append_log(leaves, n <= BLOCK)
        return pa.RecordBatch.from_pylist([{
            "tree": at[0], "n": n, "block": at[1], "ids": ids, "altered": altered,
            "log": bytes.fromhex("".join(log)), "root": bytes.fromhex(log[-1])}], _SEGMENT)

    for batch in batches:
        for row in zip(*[column.to_pylist() for column in batch.columns]):
            tree, size, number, key, leaf, other = row
            if at != (tree, number // BLOCK):
                if at is not None:
                    yield finished()
                at, n, ids, leaves, altered = (tree, number // BLOCK), size, [], [], []
            ids.append(key)
            leaves.append(leaf.hex())
            altered.append(other)
    if at is not None:
        yield finished()


def build(leaves: DataFrame, name: str) -> list[DataFrame]:
    """The logs of ``leaves(tree, n, i, id, leaf, altered)``, one written table per round.

    A tree of ``n`` leaves is in the rounds until it has one block. No leaves, one empty round.
    """
    rounds = []
    while True:
        block = F.floor(F.col("i") / BLOCK)
        dealt = leaves.select("tree", "n", "i", "id", "leaf", "altered").repartition(
            "tree", block).sortWithinPartitions("tree", "i")
        seen = Observation()
        segments = dealt.mapInArrow(_build_batches, SEGMENT_DDL).observe(
            seen, F.max("n").alias("most"))
        rounds.append(written(segments, f"{name}-log"))
        if (seen.get["most"] or 0) <= BLOCK:
            return rounds
        leaves = rounds[-1].where(F.col("n") > BLOCK).select(
            "tree", F.ceil(F.col("n") / BLOCK).alias("n"), F.col("block").alias("i"),
            F.lit(None).cast("long").alias("id"), F.col("root").alias("leaf"),
            F.lit(None).cast("binary").alias("altered"))


def roots(rounds: list[DataFrame]) -> DataFrame:
    """``(tree, root)`` of every tree, from the round that completed it."""
    done = [segments.where(F.col("n") <= BLOCK).select("tree", "root") for segments in rounds]
    return reduce(DataFrame.unionByName, done)


# --- proofs --------------------------------------------------------------

#: A path is one (left, right) pair per level, the siblings before and after, from the node up.
PATH_DDL = "array<struct<l: string, r: string>>"
ABOVE_DDL = f"tree long, block long, path {PATH_DDL}, subroot string, root string"


def paths(log: str, leaves: int, alone: bool, above: list[tuple[str, str]]) -> list[list]:
    """The path of every leaf of a block, given its log in hex and the path above its root."""
    places = positions(leaves, alone)
    found = [above]
    for level in range(len(places) - 2, -1, -1):
        nodes = [log[2 * DIGEST * p:2 * DIGEST * (p + 1)] for p in places[level]]
        below = []
        for i in range(len(nodes)):
            first = i // FANOUT * FANOUT
            pair = ("".join(nodes[first:i]), "".join(nodes[i + 1:first + FANOUT]))
            below.append([pair, *found[i // FANOUT]])
        found = below
    return found


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and the siblings on its path give."""
    for left, right in path:
        leaf = digest(left + leaf + right)
    return leaf


def proof_digest(path: list[tuple[str, str]]) -> str:
    return digest("".join(left + right for left, right in path))


def _block_paths(row: dict) -> list[list]:
    above = [(step["l"], step["r"]) for step in row["path"]]
    return paths(row["log"].hex(), len(row["ids"]), row["n"] <= BLOCK, above)


_ABOVE = pa.schema([
    ("tree", pa.int64()), ("block", pa.int64()),
    ("path", pa.list_(pa.struct([("l", pa.string()), ("r", pa.string())]))),
    ("subroot", pa.string()), ("root", pa.string()), ("id", pa.int64())])


def _path_batches(batches):
    """The path of every leaf of a round, that is of every block of the round before."""
    for batch in batches:
        for row in batch.to_pylist():
            yield pa.RecordBatch.from_pylist([
                {"tree": row["tree"], "block": row["block"] * BLOCK + i,
                 "path": [{"l": left, "r": right} for left, right in path],
                 "subroot": row["subroot"], "root": row["root"], "id": row["ids"][i]}
                for i, path in enumerate(_block_paths(row))], _ABOVE)


PROOF_DDL = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
             "folded_root string, verified boolean")


def _proof_batches(batches):
    for batch in batches:
        for row in batch.to_pylist():
            log, out = row["log"].hex(), []
            places = positions(len(row["ids"]), row["n"] <= BLOCK)[0]
            for path, place, key, other in zip(_block_paths(row), places, row["ids"],
                                               row["altered"]):
                leaf = log[2 * DIGEST * place:2 * DIGEST * (place + 1)]
                folded = fold(leaf if other is None else other.hex(), path)
                out.append((key, leaf, row["subroot"], row["root"], proof_digest(path), folded,
                            folded == row["root"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(
                    zip(*out), [pa.int64(), *[pa.string()] * 5, pa.bool_()])],
                ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])


def _descend(rounds: list[DataFrame], above: DataFrame, name: str) -> DataFrame:
    """The blocks of the first round with the paths above them.

    ``above(tree, block, path, subroot, root)`` has one row for the root of every tree.
    """
    found = None
    for turn in range(len(rounds) - 1, -1, -1):
        segments = rounds[turn]
        ending = above.join(segments.where(F.col("n") <= BLOCK).select("tree"), "tree",
                            "left_semi")
        waiting = ending if found is None else found.unionByName(ending)
        # Every block has one row on either side, so no key is hot.
        here = segments.drop("root").join(waiting, ["tree", "block"])
        if turn:
            found = written(here.mapInArrow(_path_batches, f"{ABOVE_DDL}, id long").drop("id"),
                            f"{name}-paths")
    return here


# --- the operator --------------------------------------------------------


@dataclass(frozen=True)
class MerkleParams:
    partition: str = "lang"
    tamper_modulus: int = 3  # the query's test of the proofs; 0 alters nothing


def leaf_hash(columns: dict[str, Column]) -> Column:
    """sha256 of the columns, each ``-`` if null, else its UTF-8 length, a colon and its text."""
    parts = []
    for column in columns.values():
        text = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text),
                                F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def build_manifest(docs: DataFrame, params: MerkleParams = MerkleParams()):
    """The logs of all trees: ``(partitions, rounds of their trees, rounds of the last tree)``.

    ``partitions(value, tree, n)`` names the trees; a tree's number is the rank of its first
    leaf. The log tables stay in the shared folder: they are the manifest.
    """
    ship_code(docs.sparkSession)
    docs = only(docs, **LEAF)
    columns = {name: F.col(name) for name in LEAF}
    altered = F.lit(None).cast("string")
    if params.tamper_modulus:
        hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % params.tamper_modulus == 0
        altered = F.when(hit, leaf_hash({**columns, "text": _lower(F.col("text"))}))
    leaves = docs.select(F.col(params.partition).cast("string").alias("value"), "doc_id",
                         F.unhex(leaf_hash(columns)).alias("leaf"),
                         F.unhex(altered).alias("altered"))
    order = [F.col("value").asc_nulls_first(), F.col("doc_id").asc_nulls_first(),
             F.col("leaf").asc()]
    leaves = ranked(leaves, order, "leaves")
    partitions = written(leaves.groupBy("value").agg(
        F.min("rank").alias("tree"), F.count(F.lit(1)).alias("n")), "partitions", True)
    named = leaves.join(partitions.withColumnRenamed("value", "of"),
                        F.col("value").eqNullSafe(F.col("of")))
    rounds = build(named.select("tree", "n", (F.col("rank") - F.col("tree")).alias("i"),
                                F.col("doc_id").alias("id"), "leaf", "altered"), "partition")
    # One row per partition value; its number in the last tree is its rank among them.
    tops = ranked(roots(rounds), [F.col("tree").asc()], "subroots")
    count = tops.agg(F.count(F.lit(1)).alias("c")).first()["c"]
    last = build(tops.select(
        F.lit(0).cast("long").alias("tree"), F.lit(count).cast("long").alias("n"),
        F.col("rank").alias("i"), F.col("tree").alias("id"), F.col("root").alias("leaf"),
        F.lit(None).cast("binary").alias("altered")), "last")
    return partitions, rounds, last


def prove(docs: DataFrame, params: MerkleParams = MerkleParams()) -> DataFrame:
    """Leaf, roots and proof of every row of ``docs(doc_id, source, lang, n_chars, text)``.

    ``proof_sha256`` is the hash of the siblings from the leaf up to the root, left to right,
    level by level; without any, of the empty text. ``folded_root`` is recomputed from the leaf
    and its siblings; for every ``tamper_modulus``-th id (crc32 of its decimal text) from a leaf
    whose text had its A-Z lower-cased. ``verified`` says whether it is the root.

    Rows of one partition value are numbered by doc_id, nulls first; rows of one doc_id by their
    leaf. Repeated rows are leaves each. A null partition value is a value of its own, before all
    others; null columns are hashed as ``-``, which no value is. A null doc_id is never altered.
    An empty table gives an empty result; extra columns are ignored.
    """
    _, rounds, last = build_manifest(docs, params)
    root = roots(last).select("tree", F.lower(F.hex("root")).alias("root"))
    empty = F.expr(f"cast(array() AS {PATH_DDL})")
    top = _descend(last, root.select("tree", F.lit(0).cast("long").alias("block"),
                                     empty.alias("path"), F.lit("").alias("subroot"), "root"),
                   "last")
    above = written(top.mapInArrow(_path_batches, f"{ABOVE_DDL}, id long"), "above")
    named = above.drop("tree", "block", "subroot").withColumnRenamed("id", "tree").join(
        roots(rounds).select("tree", F.lower(F.hex("root")).alias("subroot")), "tree")
    above = written(named.select("tree", F.lit(0).cast("long").alias("block"), "path", "subroot",
                                 "root"), "above")
    blocks = _descend(rounds, above, "partition")
    return blocks.mapInArrow(_proof_batches, PROOF_DDL)
