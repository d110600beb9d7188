"""Quarantine split, quality summaries, expectations and gates."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow import constants as K
from wardflow.functions import numeric
from wardflow.operators.joins import side_by_side


class QualityError(Exception):
    """A gate or freshness check did not hold."""


def accepted(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col("dq_flag") == K.VALID)


def quarantined(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col("dq_flag") != K.VALID)


def quarantine_breakdown(flagged: DataFrame) -> DataFrame:
    return (quarantined(flagged).groupBy("dq_flag").agg(F.count(F.lit(1)).alias("rows"))
            .orderBy(F.desc("rows"), "dq_flag"))


def dq_summary(bronze: DataFrame, flagged: DataFrame) -> DataFrame:
    """Row counts from Bronze to Silver and missing identifiers, one pass over each input."""
    raw = bronze.agg(
        F.count(F.lit(1)).alias("bronze_rows"),
        F.count_if(F.col("patient_id").isNull()).alias("null_patient_ids"),
        F.count_if(F.col("insurance_id").isNull()).alias("null_insurance_ids"),
    )
    checked = flagged.agg(
        F.count(F.lit(1)).alias("deduplicated_rows"),
        F.count_if(F.col("dq_flag") == K.VALID).alias("valid_rows"),
        F.count_if(F.col("dq_flag") != K.VALID).alias("quarantined_rows"),
    )
    return side_by_side(raw, checked).withColumns({
        "duplicates_removed": F.col("bronze_rows") - F.col("deduplicated_rows"),
        "valid_pct": numeric.share_pct(F.col("valid_rows"), F.col("bronze_rows"), 1),
        "quarantined_pct": numeric.share_pct(F.col("quarantined_rows"), F.col("bronze_rows"), 1),
    })


class Expectation(NamedTuple):
    column: str
    test: str
    broken: Column | None  # None: the column must be unique


def not_null(column: str) -> Expectation:
    return Expectation(column, "not_null", F.col(column).isNull())


def accepted_values(column: str, values: list[str]) -> Expectation:
    return Expectation(column, "accepted_values", ~F.col(column).isin(values))


def at_least(column: str, low: float) -> Expectation:
    return Expectation(column, f"at_least_{low}", F.col(column) < low)


def between(column: str, low: float, high: float) -> Expectation:
    return Expectation(column, f"between_{low}_{high}", ~F.col(column).between(low, high))


def unique(*columns: str) -> Expectation:
    return Expectation(", ".join(columns), "unique", None)


def admission_expectations() -> list[Expectation]:
    return [
        not_null("admission_id"), unique("admission_id"), not_null("patient_id"),
        not_null("department"), accepted_values("dq_flag", K.ADMISSION_FLAGS),
    ]


def lab_expectations() -> list[Expectation]:
    return [not_null("lab_id"), unique("lab_id", "marker"), not_null("admission_id")]


def kpi_expectations(departments: list[str]) -> list[Expectation]:
    return [
        not_null("department"), accepted_values("department", departments),
        not_null("admission_month"), not_null("total_admissions"),
        not_null("avg_los_days"), at_least("avg_los_days", 0),
        not_null("readmission_rate_pct"), between("readmission_rate_pct", 0, 100),
        not_null("readmission_status"),
        accepted_values("readmission_status", [K.STATUS_BELOW] + [
            label for _, label in reversed(K.STATUS_LEVELS)]),
    ]


def evaluate(rows: DataFrame, table: str, expectations: list[Expectation]) -> DataFrame:
    """One row per expectation with the number of failing rows.

    All row-level tests share one pass without a shuffle of rows. Uniqueness needs an exchange,
    so each unique column gets its own, reading that column alone.
    """
    row_level = [e for e in expectations if e.broken is not None]
    results = []
    if row_level:
        counts = rows.agg(*[F.count_if(e.broken).alias(f"e{i}") for i, e in enumerate(row_level)])
        results.append(counts.select(F.inline(F.array(*[
            F.struct(F.lit(e.column).alias("column_name"), F.lit(e.test).alias("test"),
                     F.col(f"e{i}").alias("failures"))
            for i, e in enumerate(row_level)]))))
    for e in expectations:
        if e.broken is None:
            key = e.column.split(", ")
            per_value = rows.na.drop(subset=key).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
            results.append(per_value.agg(
                F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("failures"))
                .select(F.lit(e.column).alias("column_name"), F.lit(e.test).alias("test"),
                        "failures"))
    return (reduce(DataFrame.unionByName, results)
            .select(F.lit(table).alias("table_name"), "column_name", "test", "failures"))


def quality_gates(admissions: DataFrame, kpis: DataFrame) -> DataFrame:
    """The two conditions a finished run must meet, one row each."""
    not_empty = admissions.agg((F.count(F.lit(1)) > 0).alias("passed")).select(
        F.lit("admissions_not_empty").alias("gate"), "passed")
    sane = kpis.agg(F.coalesce(F.max("readmission_rate_pct") < K.MAX_SANE_RATE_PCT,
                               F.lit(False)).alias("passed")).select(
        F.lit("readmission_rate_sane").alias("gate"), "passed")
    return not_empty.unionByName(sane)


def freshness_check(monthly: DataFrame, month: str = "admission_month",
                    as_of: Column | None = None, max_age_days: int | None = None) -> DataFrame:
    """Latest month present, and whether it exists and is recent enough."""
    latest = monthly.agg(F.max(month).cast("date").alias("latest_month"))
    fresh = F.col("latest_month").isNotNull()
    if max_age_days is not None:
        fresh = fresh & F.coalesce(
            F.datediff(F.current_date() if as_of is None else as_of, "latest_month")
            <= max_age_days, F.lit(False))
    return latest.withColumn("is_fresh", fresh)


def require(checks: DataFrame, passed: str) -> None:
    """Raise unless every row of a small check result passed."""
    failed = [row.asDict() for row in checks.filter(~F.col(passed)).toLocalIterator()]
    if failed:
        raise QualityError(f"failed checks: {failed}")
