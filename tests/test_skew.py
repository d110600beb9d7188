"""One key holds a third of the rows: joins split it, writes spread it, aggregates reduce it."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from helpers import executed_plan
from wardflow.operators import gold, patient_dim, quality
from wardflow.operators.dedup import latest_per_key
from wardflow.sources.lake import Lake

N = 30_000


@contextmanager
def settings(spark, **values):
    """Thresholds small enough for test data; the mechanisms are the same at any size."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def small_skew(spark):
    return settings(
        spark, spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    spark.range(0, N, 1, 8).selectExpr(
        "CONCAT('L', id) AS lab_id", "CONCAT('P', id) AS patient_id",
        "IF(id % 3 = 0, 'HOT', CONCAT('A', id)) AS admission_id", "'CBC' AS test_name",
        "'M' AS marker", "1.0D AS result_value", "0.0D AS reference_low",
        "2.0D AS reference_high", "'u' AS unit", "'NORMAL' AS result_interpretation",
        "0.0D AS deviation_from_range", "'FINAL' AS lab_status", "TRUE AS is_critical",
        "TIMESTAMP '2024-01-01 00:00:00' AS collected_at",
        "TIMESTAMP '2024-01-01 01:00:00' AS resulted_at", "60.0D AS tat_minutes",
    ).write.parquet(f"{folder}/labs")
    spark.range(0, N, 1, 8).selectExpr(
        "IF(id = 0, 'HOT', CONCAT('A', id)) AS admission_id", "'ICU' AS department",
        "'DR1' AS attending_doctor", "DATE '2024-01-01' AS admission_date",
    ).write.parquet(f"{folder}/admissions")
    spark.range(0, N, 1, 8).selectExpr(
        "IF(id % 3 = 0, 'HOT', CONCAT('P', id)) AS patient_id", "id AS admission_id",
        "IF(id % 3 = 0, DATE '2024-01-01', date_add(DATE '2024-01-01', CAST(id % 300 AS INT))) "
        "AS admission_date", "40 AS age", "'F' AS gender", "'X' AS insurance_id",
        "'AETNA' AS insurer_name",
    ).write.parquet(f"{folder}/facts")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in
            ("labs", "admissions", "facts")}


def executed(df) -> tuple[int, str]:
    n = len(df.collect())
    return n, executed_plan(df)


def test_hot_admission_is_split_in_the_critical_labs_join(spark, tables):
    with small_skew(spark):
        n, plan = executed(gold.critical_labs_watch(tables["labs"], tables["admissions"]))
    assert n == N
    assert "skew=true" in plan


def test_hot_admission_is_split_as_composed_with_the_deduplication(spark, tables):
    """Admissions straight from the deduplication are partitioned by their key already."""
    kept = latest_per_key(tables["admissions"], ["admission_id"], ["admission_date"])
    with small_skew(spark):
        n, plan = executed(gold.critical_labs_watch(tables["labs"], kept))
    assert n == N
    assert "skew=true" in plan


def test_results_without_an_admission_are_spread(spark, tables):
    labs = tables["labs"].withColumn("admission_id", F.expr(
        "IF(admission_id = 'HOT', NULL, admission_id)"))
    with small_skew(spark), settings(spark, spark__sql__adaptive__enabled="false"):
        watch = gold.critical_labs_watch(labs, tables["admissions"])
        sizes = [r["count"] for r in watch.filter("admission_id IS NULL").groupBy(
            F.spark_partition_id()).count().collect()]
    assert sum(sizes) == N // 3 and max(sizes) < N // 3 / 8


def test_hot_patient_day_is_split_in_the_asof_join(spark, tables):
    facts = tables["facts"]
    with small_skew(spark):
        dim = patient_dim.scd2_history(facts, ["insurer_name"])
        looked_up = patient_dim.asof_lookup(
            facts.select("patient_id", "admission_id", "admission_date"), dim, ["insurer_name"])
        n, plan = executed(looked_up)
    assert n == N
    assert "skew=true" in plan


def test_hot_value_is_spread_over_files(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    rows = spark.range(0, N, 1, 8).selectExpr(
        "IF(id % 3 = 0, 'ICU', CONCAT('D', id % 4)) AS department", "id", "uuid() AS text")
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB"):
        seen = lake.write_version(rows, "t", "1", ["department"])
    assert seen["rows"] == N
    folder = tmp_path / "t" / "_version=1" / "_attempt=000001"
    hot_files = list((folder / "department=ICU").glob("*.parquet"))
    cold_files = list((folder / "department=D1").glob("*.parquet"))
    assert len(hot_files) > len(cold_files) >= 1
    assert lake.read("t", version="1").count() == N


def test_uniqueness_check_reduces_before_the_exchange(spark, tables):
    checked = quality.evaluate(tables["labs"], "labs", [quality.unique("admission_id")])
    plan = executed_plan(checked)
    assert plan.index("Exchange hashpartitioning(admission_id") < plan.index(
        "partial_count(1)")
    assert checked.first()["failures"] == N // 3 - 1


def test_distinct_patients_of_a_hot_patient(spark, tables):
    silver = tables["facts"].selectExpr(
        "*", "'ICU' AS department", "year(admission_date) AS admission_year",
        "'Q1' AS admission_quarter", "1 AS length_of_stay_days", "FALSE AS readmission",
        "FALSE AS icu_stay", "CAST(1 AS DECIMAL(18,4)) AS total_cost_usd")
    total = gold.dept_monthly_kpis(silver).agg(F.sum("total_admissions")).first()[0]
    assert total == N
