from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
from llm_brute import awkward_texts, documents, empty_documents, near_duplicates as brute

from wardflow.llm import jaccard_join as jj
from wardflow.llm.common import table


def joined(docs, params=jj.JoinParams()):
    return jj.join_sets(docs, params).collect()


def copies(seed: int, words: int, n: int, edits: int) -> list[tuple]:
    """Copies of one text with up to ``edits`` words replaced, cut or added."""
    pick = random.Random(seed)
    base = [f"b{pick.randrange(10 ** 6)}" for _ in range(words)]
    out = []
    for i in range(n):
        text = list(base)
        for _ in range(pick.randrange(edits + 1)):
            place = pick.randrange(len(text))
            text[place:place + pick.randrange(2)] = [f"e{pick.randrange(10 ** 6)}"]
        out.append((seed + i, " ".join(text[:len(text) - pick.randrange(3)])))
    return out


@pytest.mark.parametrize("percent", [90, 70])
def test_sets_on_both_sides_of_the_boundary(spark, percent):
    rows = []
    for place, words in enumerate([2, 3, 6, 10, 12, 14, 18, 20, 22, 24, 28, 31, 33, 60]):
        rows += copies(1000 * place, words, 14, 2)
    params = jj.JoinParams(shingle=1, percent=percent, most_light=27 if percent == 90 else 14)
    got = joined(documents(spark, rows), params)
    want = brute(rows, 1, percent)
    assert {r.doc_id: r.component_id for r in got} == want
    assert len(set(want.values())) < len(rows) - 40


@pytest.mark.parametrize("most_light", [0, 19])
def test_the_boundary_does_not_change_the_result(spark, monkeypatch, most_light):
    rows = [row for place, words in enumerate(range(9, 32, 2))
            for row in copies(100 * place, words, 8, 1)]
    monkeypatch.setattr(jj, "boundary", lambda *a: most_light)
    got = joined(documents(spark, rows), jj.JoinParams(shingle=1))
    assert {r.doc_id: r.component_id for r in got} == brute(rows, 1, 90)


def test_large_groups_of_near_copies(spark):
    rows = copies(0, 200, 60, 12) + copies(1000, 200, 50, 16) + copies(5000, 200, 40, 4)
    got = joined(documents(spark, rows))
    assert {r.doc_id: r.component_id for r in got} == brute(rows, 3, 90)


def test_passages_that_many_documents_share(spark):
    """Lists as long as the table, whose members are no copies of each other."""
    shared = " ".join(f"common{i}" for i in range(120))
    rows = [(i, shared + " " + " ".join(f"own{i}x{j}" for j in range(i % 9))) for i in range(90)]
    got = joined(documents(spark, rows))
    assert {r.doc_id: r.component_id for r in got} == brute(rows, 3, 90)


def test_awkward_rows(spark):
    rows = awkward_texts()
    got = joined(documents(spark))
    want = brute(rows, 3, 90)
    assert len(got) == len(rows)
    assert all(r.component_id == want.get(r.doc_id) for r in got)
    assert {r.n_shingles for r in got if r.doc_id in (3, 4, 5)} == {0}
    assert [r.n_shingles for r in got if r.doc_id == 9] == [1]


def test_empty_table(spark):
    assert jj.join_sets(empty_documents(spark)).count() == 0


def test_supplied_table_against_brute_force(spark, small):
    docs = table(spark, small, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert {r.doc_id: r.component_id for r in joined(docs)} == brute(rows, 3, 90)


def test_subsets_are_all_of_their_size():
    own = np.array([3, 10, 77, 500, 9000], np.uint64)
    got = jj.subset_keys(own, 3)
    want = [sum(int(v) for v in part) % 2 ** 64
            for part in combinations(jj.textscan.mix(own, 31), 3)]
    assert sorted(got[0].tolist()) == sorted(want) and len(got[1]) == 10


def test_required_overlap_is_the_limit_and_prefixes_must_meet():
    params = jj.JoinParams()
    for a in range(1, 120):
        for b in params.partners(a):
            c = params.required(a, b)
            assert 100 * c >= 90 * (a + b - c) and 100 * (c - 1) < 90 * (a + b - c + 1)
            k = min(params.extra(a), params.extra(b))
            assert params.listed(a) >= min(a, a - c + k)
