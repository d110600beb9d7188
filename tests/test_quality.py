from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows
from helpers import admissions, executed_plan
from wardflow import constants as K
from wardflow.functions.rules import Rule, quality_flag
from wardflow.operators import ingest, quality
from wardflow.operators.admissions import flagged_admissions


def test_first_broken_rule_names_the_row(spark):
    df = spark.createDataFrame([(1,), (5,), (50,), (None,)], "v int")
    flag = quality_flag([Rule("big", F.col("v") > 10), Rule("positive", F.col("v") > 3)], "fine")
    assert rows(df.select("v", flag)) == [(1, "fine"), (5, "positive"), (50, "big"), (None, "fine")]


def test_summary_counts_duplicates_and_rejects(spark):
    twice = admissions(spark, {"admission_id": "A1"}, {"admission_id": "A1"},
                       {"admission_id": "A2", "age": "-3"},
                       {"admission_id": "A3", "patient_id": None, "insurance_id": None})
    got = quality.dq_summary(twice, flagged_admissions(twice)).first().asDict()
    assert got == {"bronze_rows": 4, "null_patient_ids": 1, "null_insurance_ids": 1,
                   "deduplicated_rows": 3, "valid_rows": 1, "quarantined_rows": 2,
                   "duplicates_removed": 1, "valid_pct": 25.0, "quarantined_pct": 50.0}


def test_breakdown_is_ordered(spark):
    flagged = flagged_admissions(admissions(
        spark, {"age": "-1"}, {"age": "-2"}, {"age": "130"}, {}))
    got = [tuple(r) for r in quality.quarantine_breakdown(flagged).collect()]
    assert got == [(K.AGE_NEGATIVE, 2), (K.AGE_UNREALISTIC, 1)]


def test_expectations(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", -1.0), (None, None, 101.0)],
                               "k string, v string, n double")
    checked = quality.evaluate(df, "t", [
        quality.not_null("k"), quality.unique("k"), quality.accepted_values("v", ["x"]),
        quality.at_least("n", 0), quality.between("n", 0, 100)])
    assert rows(checked, "column_name", "test", "failures") == sorted([
        ("k", "not_null", 1), ("k", "unique", 1), ("v", "accepted_values", 1),
        ("n", "at_least_0", 1), ("n", "between_0_100", 2)])


def test_row_level_expectations_share_one_pass(spark):
    df = spark.range(10).withColumn("v", F.col("id"))
    checked = quality.evaluate(df, "t", [quality.not_null("id"), quality.at_least("v", 3)])
    assert executed_plan(checked).count("Range (") == 1


def test_gates_and_require(spark):
    one = spark.createDataFrame([(1,)], "id int")
    sane = spark.createDataFrame([(99.9,), (None,)], "readmission_rate_pct double")
    broken = spark.createDataFrame([(100.0,)], "readmission_rate_pct double")
    quality.require(quality.quality_gates(one, sane), "passed")
    with pytest.raises(quality.QualityError, match="readmission_rate_sane"):
        quality.require(quality.quality_gates(one, broken), "passed")
    with pytest.raises(quality.QualityError, match="admissions_not_empty"):
        quality.require(quality.quality_gates(one.limit(0), sane), "passed")
    with pytest.raises(quality.QualityError):
        quality.require(quality.quality_gates(one, sane.limit(0)), "passed")


def test_freshness(spark):
    months = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 3, 1),)],
                                   "admission_month date")
    as_of = F.lit("2024-04-01").cast("date")
    assert rows(quality.freshness_check(months)) == [(date(2024, 3, 1), True)]
    assert rows(quality.freshness_check(months, as_of=as_of, max_age_days=31))[0][1] is True
    assert rows(quality.freshness_check(months, as_of=as_of, max_age_days=30))[0][1] is False
    assert rows(quality.freshness_check(months.limit(0))) == [(None, False)]


def test_load_checks(spark):
    raw = spark.createDataFrame([("x", 1), ("x", 2), (None, 3)], "d string, n int")
    loaded = ingest.audit_columns(raw, "b1", "src", F.lit("2024-01-01").cast("timestamp"))
    later = ingest.audit_columns(raw, "b2", "src", F.lit("2024-01-02").cast("timestamp"))
    both = loaded.unionByName(later)
    assert rows(ingest.write_verify(both, "d")) == [(6, 1)]
    history = ingest.load_history(both, 1).first()
    assert (history["_batch_id"], history["rows"]) == ("b2", 3)
