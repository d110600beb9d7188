"""Known counts over the middle supplied tables, worked out independently of this code."""

from __future__ import annotations

from pathlib import Path

import pytest

from verification.queries import Layers
from wardflow import constants as K
from wardflow.operators import patient_dim, quality

MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def layers(spark):
    if not Path(MIDDLE).exists():
        pytest.skip("supplied tables are not here")
    return Layers(spark, MIDDLE)


def test_admission_flags(layers):
    got = {r["dq_flag"]: r["count"] for r in layers.flagged.groupBy("dq_flag").count().collect()}
    assert got == {
        K.VALID: 12_436, K.LOS_NEGATIVE: 1_103, K.AGE_NEGATIVE: 418, K.AGE_UNREALISTIC: 641,
        K.ADMISSION_MISSING: 149, K.DISCHARGE_MISSING: 158, K.LOS_SUSPICIOUS: 64,
        K.COST_NON_POSITIVE: 31}


def test_cost_tiers_over_all_rows(layers):
    got = {r["cost_tier"]: r["count"] for r in layers.flagged.groupBy("cost_tier").count().collect()}
    assert got == {"LOW": 1_258, "MEDIUM": 3_755, "HIGH": 7_476, "VERY_HIGH": 2_511}


def test_lab_grain(layers):
    ids = quality.evaluate(layers.bronze_labs, "labs", [quality.unique("lab_id")]).first()
    assert layers.bronze_labs.count() - ids["failures"] == 45_832


def test_insurer_history(layers):
    counts = patient_dim.scd2_counts(layers.insurer_history).first()
    assert (counts["total_versions"], counts["current_versions"]) == (12_727, 1_500)
    assert layers.insurer_history.filter("valid_to < valid_from").count() == 0


def test_asof_keeps_every_fact(layers):
    facts = layers.facts.withColumnRenamed("insurer_name", "own")
    looked_up = patient_dim.asof_lookup(facts, layers.insurer_history, ["insurer_name"])
    assert looked_up.count() == 15_000
    assert looked_up.filter("own = insurer_name").count() == 14_976
