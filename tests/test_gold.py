from __future__ import annotations

from decimal import Decimal

import pytest

from conftest import rows
from helpers import admissions, executed_plan, labs
from wardflow.functions import labels
from wardflow.operators import gold, joins, reports
from wardflow.operators.admissions import flagged_admissions
from wardflow.operators.labs import flagged_labs
from wardflow.operators.quality import accepted


def silver(spark, *changes):
    return accepted(flagged_admissions(admissions(spark, *changes)))


# Published monthly figures of one department: stay, rate and their three-row means.
PUBLISHED = [("2024-01", 21.79, 16.81, 21.79, 16.81), ("2024-02", 21.88, 16.67, 21.84, 16.74),
             ("2024-03", 23.89, 16.54, 22.52, 16.67)]


def test_rolling_means_match_published_rows(spark):
    df = spark.createDataFrame([("CARDIOLOGY", m, a, b) for m, a, b, _, _ in PUBLISHED],
                               "department string, year_month string, los double, rate double")
    got = rows(df.select("year_month", gold.rolling_mean("los", "department", "year_month"),
                         gold.rolling_mean("rate", "department", "year_month")))
    assert got == [(m, x, y) for m, _, _, x, y in PUBLISHED]


def test_rolling_window_counts_rows_not_months(spark):
    df = spark.createDataFrame([("D", "2024-01", 1.0), ("D", "2024-02", 2.0), ("D", "2024-06", 6.0)],
                               "d string, m string, v double")
    assert rows(df.select("m", gold.rolling_mean("v", "d", "m")))[-1] == ("2024-06", 3.0)


@pytest.mark.parametrize("rate, status, tier", [
    (15.0, "OK", "LOW_RISK"), (15.01, "WARNING", "MEDIUM_RISK"), (20.0, "WARNING", "MEDIUM_RISK"),
    (20.01, "CRITICAL", "MEDIUM_RISK"), (25.0, "CRITICAL", "MEDIUM_RISK"),
    (25.01, "CRITICAL", "HIGH_RISK")])
def test_levels_are_strict(spark, rate, status, tier):
    df = spark.createDataFrame([(rate,)], "readmission_rate_pct double")
    assert rows(df.select(labels.readmission_status(), labels.risk_tier())) == [(status, tier)]


# Published group sizes, readmissions, rates and tiers.
PUBLISHED_GROUPS = [(52, 7, 13.46, "LOW_RISK"), (73, 12, 16.44, "MEDIUM_RISK"),
                    (75, 11, 14.67, "LOW_RISK")]


def test_rates_and_tiers_match_published_groups(spark):
    from pyspark.sql import functions as F
    from wardflow.functions import numeric
    df = spark.createDataFrame([g[:2] for g in PUBLISHED_GROUPS], "n int, r int").withColumn(
        "readmission_rate_pct", numeric.share_pct(F.col("r"), F.col("n")))
    got = rows(df.select("n", "r", "readmission_rate_pct", labels.risk_tier()))
    assert got == sorted(PUBLISHED_GROUPS)


def test_monthly_kpis(spark):
    facts = silver(
        spark,
        {"patient_id": "P1", "age": "40", "readmission": "true", "total_cost_usd": "100.10"},
        {"patient_id": "P1", "age": "41", "discharge_date": "2024-01-11", "icu_stay": "true",
         "total_cost_usd": "200.20"},
        {"patient_id": "P2", "age": "42", "discharge_date": "2024-01-10",
         "total_cost_usd": "300.31"},
        {"patient_id": "P3", "admission_date": "2024-03-01", "discharge_date": "2024-03-02"})
    got = {r["year_month"]: r.asDict() for r in gold.dept_monthly_kpis(facts).collect()}
    january, march = got["2024-01"], got["2024-03"]
    assert january["total_admissions"] == 3 and january["unique_patients"] == 2
    assert (january["avg_los_days"], january["min_los_days"], january["max_los_days"]) == (2.0, 0, 5)
    assert january["stddev_los_days"] == 2.65 and march["stddev_los_days"] is None
    assert january["readmissions"] == 1 and january["readmission_rate_pct"] == 33.33
    assert january["readmission_status"] == "CRITICAL" and march["readmission_status"] == "OK"
    assert january["total_revenue_usd"] == 600.61 and january["avg_cost_usd"] == 200.2
    assert january["avg_patient_age"] == 41.0 and january["icu_admissions"] == 1
    assert march["rolling_3mo_avg_los"] == 1.5


def test_distinct_counts_shuffle_only_what_they_count(spark):
    facts = spark.range(100).selectExpr(
        "IF(id % 5 = 0, NULL, CAST(id % 3 AS STRING)) AS g", "id % 10 AS p", "id AS a")
    from pyspark.sql import functions as F
    got = joins.aggregate_with_distincts(
        facts, ["g"], [F.sum("a").alias("s")], {"people": "p"})
    expected = facts.groupBy("g").agg(F.sum("a").alias("s"), F.count_distinct("p").alias("people"))
    assert rows(got) == rows(expected)
    assert "Expand" not in executed_plan(got)


def test_small_groups_are_left_out(spark):
    facts = silver(spark, *([{"diagnosis": "nine"}] * 9 + [{"diagnosis": "ten"}] * 10))
    assert rows(gold.readmission_analysis(facts), "diagnosis", "total_admissions") == [("TEN", 10)]
    assert gold.readmission_analysis(facts, min_group=5).count() == 2


def test_financial_summary(spark):
    facts = silver(spark, {"total_cost_usd": "100"}, {"total_cost_usd": "250.5", "insurer_name": None},
                   {"total_cost_usd": "300"})
    got = {r["insurer_name"]: r for r in gold.financial_summary(facts).collect()}
    assert got["AETNA"]["admissions"] == 2 and got["AETNA"]["total_revenue_usd"] == 400.0
    assert got["AETNA"]["avg_revenue_per_admission"] == 200.0
    assert (got["SELF_PAY"]["min_cost"], got["SELF_PAY"]["max_cost"]) == (250.5, 250.5)


def test_critical_lab_of_a_quarantined_admission_stays(spark):
    facts = silver(spark, {}, {"age": "-1"})
    results = accepted(flagged_labs(labs(
        spark, {"admission_id": "A1", "is_critical": "true"},
        {"admission_id": "A2", "is_critical": "true", "patient_id": "P9"},
        {"admission_id": "A1"})))
    from pyspark.sql import functions as F
    watch = gold.critical_labs_watch(
        results, facts, F.lit("2024-01-11 09:30:00").cast("timestamp"))
    assert rows(watch, "lab_id", "patient_id", "department", "hours_since_collection") == [
        ("L1", "P1", "CARDIOLOGY", 1.5), ("L2", "P9", None, 1.5)]


def test_reports(spark):
    facts = silver(spark, {"total_cost_usd": "1000000"}, {"department": "icu", "icu_stay": "true"})
    stats = rows(reports.silver_dept_stats(facts), "department", "admissions", "avg_cost_usd")
    assert stats == [("CARDIOLOGY", 1, 1000000.0), ("ICU", 1, 10000.0)]
    revenue = reports.revenue_by_dept(gold.financial_summary(facts))
    assert [tuple(r) for r in revenue.collect()] == [("CARDIOLOGY", 1.0), ("ICU", 0.01)]


def test_sums_are_exact(spark):
    facts = silver(spark, *[{"total_cost_usd": "0.10"}] * 30)
    assert facts.agg({"total_cost_usd": "sum"}).first()[0] == Decimal("3.0000")
