from __future__ import annotations

import hashlib
import zlib

import pytest
from llm_brute import documents, empty_documents, fold as lower

from wardflow.llm import merkle_manifest as mm

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def siblings(tree: list[list[str]], i: int) -> list[tuple[str, str]]:
    out = []
    for nodes in tree[:-1]:
        first = i // 8 * 8
        out.append(("".join(nodes[first:i]), "".join(nodes[i + 1:first + 8])))
        i //= 8
    return out


def brute(rows: list[tuple], tampered=lambda i: zlib.crc32(str(i).encode()) % 3 == 0):
    by: dict = {}
    for row in rows:
        by.setdefault(row[2], []).append(row)
    names = sorted(by, key=lambda k: (k is not None, (k or "").encode()))
    trees = []
    for name in names:
        own = sorted(by[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((own, levels([leaf(r) for r in own])))
    top = levels([tree[-1][0] for _, tree in trees])
    out = []
    for place, (own, tree) in enumerate(trees):
        for i, row in enumerate(own):
            path, folded = siblings(tree, i) + siblings(top, place), leaf(row)
            if row[0] is not None and tampered(row[0]):
                folded = leaf((*row[:4], None if row[4] is None else lower(row[4])))
            for left, right in path:
                folded = sha(left + folded + right)
            root = top[-1][0]
            out.append((row[0], leaf(row), tree[-1][0], root,
                        sha("".join(a + b for a, b in path)), folded, folded == root))
    return sorted(out, key=str)


def proved(docs, *args):
    return sorted((tuple(r) for r in mm.prove(docs, *args).collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame(
        [(*r, "?", "?", "?", "?") for r in rows],
        "doc_id long, source string, lang string, n_chars long, text string, tree string, "
        "n string, root string, `_place` string")


@pytest.mark.parametrize("counts", [[1], [2, 8, 9, 511, 512, 513, 4097, 65], [1] * 70])
def test_trees_of_many_sizes(spark, counts):
    rows = [(1000 * place + i, "s", f"l{place:02d}", i, f"Text {i} of {place}")
            for place, n in enumerate(counts) for i in range(n)]
    assert proved(table(spark, rows)) == brute(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(1, "s", "en", 3, "ABC"), (1, "s", "en", 3, "ABC"), (1, "s", "en", 3, "abd"),
            (None, None, None, None, None), (None, "-", "en", None, "-"), (3, "", "", 0, ""),
            (4, "é", "z", -1, "É ü A"), (5, "x", "Z", 9, "a" * 300_000), (6, "1:a", "en", 1, None),
            (None, "s", None, 1, "Q")]
    got = proved(table(spark, rows))
    assert got == brute(rows)
    assert {r[-1] for r in got if r[0] is None} == {True}


def test_empty_table(spark):
    assert mm.prove(empty_documents(spark)).count() == 0


def test_unaltered_leaves_verify_and_altered_text_does_not(spark):
    rows = [(i, "s", "en", 1, f"Upper {i}" if i % 2 else f"lower {i}") for i in range(40)]
    assert all(r[-1] for r in proved(table(spark, rows), mm.MerkleParams(tamper_modulus=0)))
    got = proved(table(spark, rows), mm.MerkleParams(tamper_modulus=1))
    assert [r[-1] for r in sorted(got)] == [i % 2 == 0 for i in range(40)]


def test_partition_column_is_a_parameter(spark):
    rows = [(i, f"s{i % 3}", "en", 1, f"t{i}") for i in range(30)]
    got = proved(table(spark, rows), mm.MerkleParams(partition="source", tamper_modulus=0))
    swapped = brute([(r[0], r[1], r[1], r[3], r[4]) for r in rows], lambda i: False)
    assert len({r[2] for r in got}) == 3 and all(r[-1] for r in got)
    assert [r[0] for r in got] == [r[0] for r in swapped]


@pytest.mark.parametrize("leaves", [1, 2, 7, 8, 9, 63, 64, 65, 100, 511, 512])
@pytest.mark.parametrize("alone", [True, False])
def test_positions_are_those_of_the_log(leaves, alone):
    """Every node is where the closed form says: the log read by position is the tree by level."""
    names = [sha(str(i)) for i in range(leaves)]
    log = mm.append_log(names, alone)
    want = [names]
    for _ in mm.levels_of(leaves, alone)[1:]:
        want.append([sha("".join(want[-1][i:i + 8])) for i in range(0, len(want[-1]), 8)])
    places = mm.positions(leaves, alone)
    assert [[log[p] for p in level] for level in places] == want
    assert sorted(p for level in places for p in level) == list(range(len(log)))
    assert len(log) <= mm.subtree(mm.HEIGHT)


def test_log_rows_hold_their_blocks(spark):
    rows = [(i, "s", "en", 1, f"t{i}") for i in range(1200)]
    partitions, rounds, last = mm.build_manifest(table(spark, rows))
    first = rounds[0].orderBy("block").collect()
    assert [len(r.ids) for r in first] == [512, 512, 176] and len(rounds) == 2
    assert [len(r["log"]) // 32 for r in first][:2] == [mm.subtree(3)] * 2
    assert partitions.collect()[0].n == 1200 and len(last) == 1
