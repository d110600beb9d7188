"""Pipeline stages decide about rows: ids may be missing, shared, or on several equal rows."""

from __future__ import annotations

import random

import pytest
from llm_brute import documents, empty_documents

from wardflow.llm import stages
from wardflow.llm.common import table, written
from wardflow.llm.perplexity_rules import judge_quality


def prose(seed: int, words: int = 90) -> str:
    pick = random.Random(seed)
    return " ".join(f"{pick.choice('abcdefgh')}word{pick.randrange(500)}" for _ in range(words))


def kept(stage, spark, rows, small, as_table):
    docs = documents(spark, rows)
    out = stage(spark, written(docs, "rows") if as_table else docs, small)
    assert out.columns == docs.columns
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)


@pytest.mark.parametrize("as_table", [False, True])
def test_quality_judges_each_row_of_a_shared_or_missing_id(spark, small, as_table):
    good = [prose(i) for i in range(30)]
    rows = [(1, good[0]), (1, "too short"), (None, good[1]), (None, "short as well"),
            (2, None), (2, ""), (3, good[2]), (3, good[2])]
    rows += [(100 + i, t) for i, t in enumerate(good[3:])]
    got = kept(stages.quality_rules, spark, rows, small, as_table)
    alone = judge_quality(documents(spark, [(i, t) for i, (_, t) in enumerate(rows)])).collect()
    assert got == sorted([rows[r.doc_id] for r in alone if r.kept], key=str)
    assert all(t in good for _, t in got) and {(1, good[0]), (None, good[1])} & set(got)


def test_one_row_of_each_group_of_copies_stays(spark, small):
    a, b, c, d = (prose(i) for i in range(4))
    near = a.rsplit(" ", 1)[0] + " changed"
    rows = [(5, a), (5, a), (4, near), (None, a), (5, b), (None, b), (None, c), (None, c),
            (7, d), (8, None), (8, None), (None, ""), (9, " ")]
    got = kept(stages.near_dedup, spark, rows, small, False)
    assert got == sorted([(4, near), (5, b), (None, c), (7, d), (8, None), (8, None), (None, ""),
                          (9, " ")], key=str)


def test_leaks_go_by_row(spark, small):
    item = max((r.text for r in table(spark, small, "benchmark").collect()), key=len)
    leak, clean = prose(1) + " " + item + " " + prose(2), prose(3)
    rows = [(1, leak), (1, clean), (None, leak), (None, clean), (2, clean), (2, clean), (3, None)]
    got = kept(stages.decontamination, spark, rows, small, True)
    assert got == sorted([(1, clean), (None, clean), (2, clean), (2, clean), (3, None)], key=str)


@pytest.mark.parametrize("stage", [stages.quality_rules, stages.near_dedup,
                                   stages.decontamination])
def test_empty_tables(spark, small, stage):
    assert stage(spark, empty_documents(spark), small).count() == 0
