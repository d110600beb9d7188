"""Near-duplicates of one of several texts under a doc_id."""

from __future__ import annotations

from wardflow.llm import minhash_dedup as mh


def test_unshared_text_of_an_id_does_not_hide_the_shared_one(spark):
    sets = spark.createDataFrame(
        [(1, list(range(100))), (1, list(range(1000, 2000))), (2, list(range(10, 110))),
         (3, list(range(5000, 5050)))], "doc_id long, shingles array<long>")
    entries = spark.createDataFrame(
        [(7, 1, 100, 1), (7, 2, 100, 2), (8, 3, 50, 3)],
        "key long, rep long, n long, component long")
    got = {r.rep: r.u for r in mh._common_shingles(entries, sets).collect()}
    assert got == {1: 90, 2: 90, 3: 0}
    able = {r.rep for r in mh._able(entries, sets, 80).collect()}
    assert able == {1, 2}
