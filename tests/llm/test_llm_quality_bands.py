"""How much labelled junk the perplexity bands reject, and how much clean text they lose."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wardflow.llm import perplexity_rules as pr
from wardflow.llm.common import table

ROOT = "/root/testdata/sf0.1"


def test_symbols_have_a_class_of_their_own():
    classes = pr.byte_classes().tolist()
    others = {c for b, c in enumerate(classes) if b not in pr.SYMBOLS}
    assert not {classes[b] for b in pr.SYMBOLS} & others and max(classes) < 64


@pytest.mark.skipif(not Path(ROOT).exists(), reason="supplied tables are not here")
def test_bands_catch_junk_and_lose_little(spark):
    got = pr.judge_quality(table(spark, ROOT, "documents")).join(
        table(spark, ROOT, "labels"), "doc_id").where("NOT base_failed")
    kept = {r.quality: (r.kept, r.n) for r in got.groupBy("quality").agg(
        F.sum(F.col("kept").cast("int")).alias("kept"), F.count("kept").alias("n")).collect()}
    print("kept of all", kept)
    assert kept[0][0] / kept[0][1] < 0.27 and kept[1][0] / kept[1][1] > 0.99
