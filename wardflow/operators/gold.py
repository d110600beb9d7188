"""Gold tables built from Silver admissions and labs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow import constants as K
from wardflow.functions import labels, numeric
from wardflow.operators.joins import aggregate_with_distincts


def rolling_mean(column: str, partition: str, order: str, scale: int = 2) -> Column:
    """Mean of this row and the two before it: rows, not calendar months."""
    window = Window.partitionBy(partition).orderBy(order).rowsBetween(1 - K.ROLLING_MONTHS, 0)
    return numeric.rounded(F.avg(column).over(window), scale)


def dept_monthly_kpis(admissions: DataFrame) -> DataFrame:
    """Monthly figures per department with three-row rolling means.

    Rows are grouped on the month as a date; its text form, year and quarter are worked out per
    group, not per row. The windows run on the aggregate, at most departments x months rows.
    """
    keys = ["department", "month"]
    n, readmitted = F.count(F.lit(1)), numeric.count_true("readmission")
    measures = [
        n.alias("total_admissions"),
        numeric.mean("length_of_stay_days", 2).alias("avg_los_days"),
        numeric.stddev_of_integers("length_of_stay_days", 2).alias("stddev_los_days"),
        F.min("length_of_stay_days").alias("min_los_days"),
        F.max("length_of_stay_days").alias("max_los_days"),
        readmitted.alias("readmissions"),
        numeric.share_pct(readmitted, n).alias("readmission_rate_pct"),
        numeric.mean("total_cost_usd", 2).alias("avg_cost_usd"),
        numeric.rounded_total(F.sum("total_cost_usd")).alias("total_revenue_usd"),
        numeric.mean("age", 1).alias("avg_patient_age"),
        numeric.count_true("icu_stay").alias("icu_admissions"),
    ]
    months = admissions.withColumn("month", F.trunc("admission_date", "MM"))
    kpis = aggregate_with_distincts(months, keys, measures, {"unique_patients": "patient_id"})
    calendar = [
        F.date_format("month", "yyyy-MM").alias("year_month"),
        F.year("month").alias("admission_year"),
        labels.quarter_label("month").alias("admission_quarter"),
    ]
    figures = [c for c in kpis.columns if c not in keys]
    return kpis.select("department", *calendar, *figures).withColumns({
        "rolling_3mo_avg_los": rolling_mean("avg_los_days", "department", "year_month"),
        "rolling_3mo_readmission_pct": rolling_mean(
            "readmission_rate_pct", "department", "year_month"),
        "readmission_status": labels.readmission_status(),
    })


def readmission_analysis(admissions: DataFrame, min_group: int = K.MIN_GROUP) -> DataFrame:
    """Readmission rate and risk tier of every large enough patient group."""
    n, readmitted = F.count(F.lit(1)), numeric.count_true("readmission")
    groups = admissions.groupBy("department", "diagnosis", "age_group").agg(
        n.alias("total_admissions"),
        readmitted.alias("readmissions"),
        numeric.share_pct(readmitted, n).alias("readmission_rate_pct"),
        numeric.mean("length_of_stay_days", 2).alias("avg_los"),
        numeric.mean("total_cost_usd", 2).alias("avg_cost"),
    )
    return (groups.filter(F.col("total_admissions") >= min_group)
            .withColumn("readmission_risk_tier", labels.risk_tier()))


def financial_summary(admissions: DataFrame) -> DataFrame:
    keys = ["department", "insurer_name", "admission_year", "admission_quarter", "cost_tier"]
    return admissions.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("admissions"),
        numeric.rounded_total(F.sum("total_cost_usd")).alias("total_revenue_usd"),
        numeric.mean("total_cost_usd", 2).alias("avg_revenue_per_admission"),
        numeric.rounded(F.min("total_cost_usd"), 2).alias("min_cost"),
        numeric.rounded(F.max("total_cost_usd"), 2).alias("max_cost"),
        numeric.mean("num_procedures", 2).alias("avg_procedures"),
    )


# The columns of the table and their order are its contract.
CRITICAL_LAB_COLUMNS = [
    "lab_id", "patient_id", "admission_id", "department", "attending_doctor", "test_name",
    "marker", "result_value", "reference_low", "reference_high", "unit",
    "result_interpretation", "deviation_from_range", "lab_status", "collected_at",
    "resulted_at", "tat_minutes", "admission_date",
]


def critical_labs_watch(labs: DataFrame, admissions: DataFrame,
                        as_of: Column | None = None) -> DataFrame:
    """Critical results with the department and doctor of their admission.

    A left join: a result whose admission was quarantined stays, without a department. The
    critical filter and the four admission columns reach the scans. ``as_of`` fixes "now".

    ``_spread`` is 0 on both sides for every admission. Results without one, which match nothing,
    get many values of it and so many partitions; and because neither input is partitioned by
    both keys, both are exchanged anew and adaptive execution can split a hot admission.
    """
    key = F.col("admission_id")
    visit = admissions.select("admission_id", "department", "attending_doctor", "admission_date",
                              F.when(key.isNull(), -1).otherwise(0).alias("_spread"))
    critical = labs.filter(F.col("is_critical")).withColumn(
        "_spread", F.when(key.isNull(), F.pmod(F.hash("lab_id", "marker"), F.lit(1024)))
        .otherwise(0))
    now = F.current_timestamp() if as_of is None else as_of
    return (critical.join(visit, ["admission_id", "_spread"], "left")
            .select(*CRITICAL_LAB_COLUMNS)
            .withColumn("hours_since_collection", numeric.rounded(
                numeric.seconds_between(F.col("collected_at"), now) / 3600, 1)))


def with_built_at(table: DataFrame) -> DataFrame:
    return table.withColumn("_built_at", F.current_timestamp())
