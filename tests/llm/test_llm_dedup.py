from __future__ import annotations

import random

import numpy as np
import pytest
from llm_brute import awkward_texts, documents, empty_documents, near_duplicates as brute

from wardflow.llm import textscan
from wardflow.llm.common import table
from wardflow.llm.components import components
from wardflow.llm.minhash_dedup import NearDupParams, band_keys, near_duplicates, sketch


def family(seed: int, n: int, edits: int) -> list[tuple]:
    """Copies of one text with up to ``edits`` words replaced: similarities around the limit."""
    pick = random.Random(seed)
    base = [f"b{pick.randrange(10 ** 6)}" for _ in range(80)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(pick.randrange(edits + 1)):
            words[pick.randrange(len(words))] = f"e{pick.randrange(10 ** 6)}"
        out.append((i * 3 + seed, " ".join(words)))
    return out


@pytest.mark.parametrize("size", [2, 5])
def test_components_of_a_large_group_of_near_copies(spark, size):
    rows = family(1, 60, 9) + family(1000, 40, 14)
    got = near_duplicates(documents(spark, rows), NearDupParams(shingle=size)).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(rows, size)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_awkward_rows(spark):
    rows = awkward_texts()
    got = near_duplicates(documents(spark), NearDupParams(shingle=2)).collect()
    assert len(got) == len(rows)
    want = brute(rows, 2)
    for r in got:
        assert r.component_id == want.get(r.doc_id)
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)
    assert {r.n_shingles for r in got if r.doc_id in (3, 4, 5)} == {0}
    assert [r.n_shingles for r in got if r.doc_id == 9] == [1]


def test_empty_table(spark):
    assert near_duplicates(empty_documents(spark)).count() == 0


def test_supplied_table_against_brute_force(spark, small):
    docs = table(spark, small, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = near_duplicates(docs, NearDupParams(shingle=2)).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(rows, 2)


def test_sketch_fills_every_coordinate_and_estimates_similarity():
    numbers = textscan.mix(np.arange(3000, dtype=np.uint64), 1)
    for n in (1, 5, 40, 1000):
        a, b = np.sort(numbers[:n * 2]), np.sort(numbers[n // 2:n * 2 + n // 2])
        table_ = sketch([a, b], 512)
        assert (table_ != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((table_[0] == table_[1]).mean() - true) < 0.12
        same = sketch([a, a], 128)
        assert (band_keys(same, 32)[0] == band_keys(same, 32)[1]).all()


def test_components_of_long_chains_and_hubs(spark):
    pick = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 300)]
    links += [(250, 130), (7, 7), (None, 3)]
    pick.shuffle(links)
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    nodes = {*range(100, 161), *range(200, 300), 5}
    assert {r.node: r.component for r in got} == {n: 5 for n in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
