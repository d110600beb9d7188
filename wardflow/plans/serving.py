"""Read-side queries behind the two dashboards, over Gold tables.

Averages of monthly or group averages are unweighted, and summed monthly distinct patients count
a returning patient once per month; dashboards have always shown them so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow import constants as K
from wardflow.functions import labels, numeric
from wardflow.operators.joins import side_by_side

mean = numeric.mean_of_doubles


def _revenue_m(column: str = "total_revenue_usd"):
    return numeric.millions(numeric.revenue_sum(column)).alias("total_revenue_m")


# --- service endpoints ---------------------------------------------------

def summary(kpis: DataFrame, critical: DataFrame, quarantined_rows: DataFrame,
            audit: DataFrame | None = None) -> DataFrame:
    """Headline figures. ``quarantined_rows`` is any table holding the rejected admissions; with
    the ``audit`` log comes the time of the last step, ``last_run``."""
    per_dept = kpis.groupBy("department").agg(
        F.sum("total_admissions").alias("admissions"),
        numeric.revenue_sum("total_revenue_usd").alias("revenue"),
        numeric.ratio(numeric.exact_sum("readmission_rate_pct"),
                      F.count("readmission_rate_pct")).alias("rate"))
    totals = per_dept.agg(
        F.coalesce(F.sum("admissions"), F.lit(0)).alias("total_admissions"),
        numeric.millions(F.sum("revenue")).alias("total_revenue_m"),
        numeric.rounded(F.avg("rate"), 2).alias("avg_readmission"),
        F.count(F.lit(1)).alias("departments"))
    alerts = critical.agg(F.count(F.lit(1)).alias("critical_labs"))
    rejected = quarantined_rows.agg(F.count(F.lit(1)).alias("quarantined"))
    total = F.col("total_admissions") + F.col("quarantined")
    runs = [] if audit is None else [audit.agg(F.max("finished_at").alias("last_run"))]
    return side_by_side(totals, alerts, rejected, *runs).withColumn(
        "data_quality_pct", numeric.share_pct(F.col("total_admissions"), total, 1))


def dept_annual(kpis: DataFrame) -> DataFrame:
    return (kpis.groupBy("department").agg(
        F.sum("total_admissions").alias("total_admissions"),
        F.sum("unique_patients").alias("unique_patients"),
        mean("avg_los_days", 1).alias("avg_los"),
        mean("readmission_rate_pct", 1).alias("avg_readmit_rate"),
        _revenue_m(),
        F.sum("icu_admissions").alias("icu_admissions"),
        mean("avg_cost_usd", 0).cast("bigint").alias("avg_cost"))
        .orderBy(F.desc("total_admissions"), "department"))


def monthly_trends(kpis: DataFrame) -> DataFrame:
    """Months by departments, one column for every department in the table.

    The names are read from Gold first, one row per department and month there. Admissions
    without a department are counted under ``UNKNOWN``.
    """
    named = kpis.withColumn("department", F.coalesce("department", F.lit(K.UNKNOWN_DEPARTMENT)))
    departments = [r[0] for r in named.select("department").distinct().orderBy("department")
                   .collect()]
    return (named.groupBy("year_month").pivot("department", departments)
            .agg(F.sum("total_admissions")).na.fill(0).orderBy("year_month"))


def readmission_risk(readmissions: DataFrame) -> DataFrame:
    return (readmissions.groupBy("readmission_risk_tier")
            .agg(F.sum("total_admissions").alias("cases"),
                 mean("readmission_rate_pct", 1).alias("avg_rate"))
            .orderBy("readmission_risk_tier"))


def critical_labs(critical: DataFrame, top: int = K.TOP_CRITICAL_LABS) -> DataFrame:
    rounded = ["result_value", "reference_low", "reference_high", "deviation_from_range"]
    return (critical.orderBy("lab_id", "marker").limit(top)
            .select("lab_id", "patient_id", "test_name", "marker", "unit",
                    *[numeric.rounded(numeric.finite_or_null(c), 3).alias(c) for c in rounded],
                    "result_interpretation", "lab_status", "department", "attending_doctor",
                    "collected_at"))


def insurer_revenue(finance: DataFrame) -> DataFrame:
    return (finance.groupBy("insurer_name").agg(
        _revenue_m(),
        F.sum("admissions").alias("admissions"),
        mean("avg_revenue_per_admission", 0).cast("bigint").alias("avg_rev_per_adm"))
        .orderBy(F.desc("total_revenue_m"), "insurer_name"))


def cost_tier_mix(finance: DataFrame) -> DataFrame:
    return (finance.groupBy("cost_tier")
            .agg(F.sum("admissions").alias("admissions"), _revenue_m())
            .orderBy(labels.tier_rank(), "cost_tier"))


def doctor_alerts(critical: DataFrame, top: int = K.TOP_ALERT_DOCTORS) -> DataFrame:
    """Doctors with the most critical results; results without a doctor are left out.

    Counted per doctor and department first, so the joined department names come from one row
    per department and never from the results themselves.
    """
    per_dept = (critical.filter(F.col("attending_doctor").isNotNull())
                .groupBy("attending_doctor", "department").agg(
        F.count(F.lit(1)).alias("critical_labs"),
        F.count_if(F.col("result_interpretation") == "HIGH").alias("high_count"),
        F.count_if(F.col("result_interpretation") == "LOW").alias("low_count")))
    return (per_dept.groupBy("attending_doctor").agg(
        F.sum("critical_labs").alias("critical_labs"),
        F.array_join(F.sort_array(F.collect_list("department")), K.LIST_SEPARATOR).alias("departments"),
        F.sum("high_count").alias("high_count"),
        F.sum("low_count").alias("low_count"))
        .orderBy(F.desc("critical_labs"), "attending_doctor").limit(top))


def quarterly(kpis: DataFrame) -> DataFrame:
    return (kpis.groupBy("admission_quarter", "department").agg(
        F.sum("total_admissions").alias("total_admissions"),
        mean("readmission_rate_pct", 1).alias("readmit_rate"),
        _revenue_m())
        .orderBy("admission_quarter", "department"))


# --- overview tab --------------------------------------------------------

def overview(kpis: DataFrame) -> DataFrame:
    total = numeric.revenue_sum("total_revenue_usd")
    return kpis.agg(
        F.sum("total_admissions").alias("total_admissions"),
        mean("avg_los_days", 1).alias("avg_los_days"),
        numeric.rounded_total(total).alias("total_revenue_usd"),
        labels.magnitude_label(total, "$").alias("revenue_label"),
        mean("readmission_rate_pct", 1).alias("avg_readmission_pct"))


def monthly_admissions(kpis: DataFrame) -> DataFrame:
    return (kpis.groupBy("department", "year_month")
            .agg(F.sum("total_admissions").alias("admissions"))
            .orderBy("department", "year_month"))


def status_mix(kpis: DataFrame) -> DataFrame:
    status = F.coalesce("readmission_status", F.lit("UNKNOWN")).alias("readmission_status")
    return (kpis.groupBy(status).agg(F.count(F.lit(1)).alias("months"))
            .orderBy("readmission_status"))


def latest_month_per_dept(kpis: DataFrame) -> DataFrame:
    newest = F.row_number().over(
        Window.partitionBy("department").orderBy(F.desc("year_month")))
    return (kpis.withColumn("_rank", newest).filter(F.col("_rank") == 1)
            .select("department", "year_month", "total_admissions", "avg_los_days",
                    "readmission_rate_pct", "icu_admissions", "avg_cost_usd",
                    "total_revenue_usd", "readmission_status")
            .orderBy("department"))


# --- finance tab ---------------------------------------------------------

def finance_headline(finance: DataFrame) -> DataFrame:
    total = numeric.revenue_sum("total_revenue_usd")
    return finance.agg(
        numeric.rounded_total(total).alias("total_revenue_usd"),
        labels.magnitude_label(total, "$").alias("revenue_label"),
        mean("avg_revenue_per_admission", 0).alias("avg_revenue_per_admission"))


def top_dept_insurer(finance: DataFrame) -> DataFrame:
    """Best department and best insurer by revenue; equal revenues go to the first name."""
    def best(column: str) -> DataFrame:
        return (finance.groupBy(column)
                .agg(numeric.revenue_sum("total_revenue_usd").alias("revenue"))
                .orderBy(F.desc("revenue"), column).limit(1)
                .select(F.lit(column).alias("dimension"), F.col(column).alias("top_name"),
                        numeric.rounded_total(F.col("revenue")).alias("revenue_usd")))
    return best("department").unionByName(best("insurer_name"))


def quarterly_revenue(finance: DataFrame) -> DataFrame:
    return (finance.groupBy("department", "admission_quarter")
            .agg(numeric.millions(numeric.revenue_sum("total_revenue_usd")).alias("revenue_m"))
            .orderBy("department", "admission_quarter"))


def finance_detail(finance: DataFrame) -> DataFrame:
    return (finance.groupBy("department", "insurer_name").agg(
        F.sum("admissions").alias("admissions"),
        numeric.rounded_total(numeric.revenue_sum("total_revenue_usd")).alias("revenue_usd"),
        mean("avg_revenue_per_admission", 0).alias("avg_rev_per_adm"),
        mean("avg_procedures", 1).alias("avg_procedures"))
        .orderBy(F.desc("revenue_usd"), "department", "insurer_name"))


# --- clinical tab --------------------------------------------------------

def clinical_headline(critical: DataFrame, readmissions: DataFrame) -> DataFrame:
    """Per department first: the distinct count then runs on a handful of rows."""
    per_dept = critical.groupBy("department").agg(
        F.count(F.lit(1)).alias("n"), numeric.exact_sum("tat_minutes").alias("tat"),
        F.count("tat_minutes").alias("n_tat"))
    labs = per_dept.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("critical_labs"),
        F.count(F.lit(1)).alias("departments"),
        numeric.rounded(numeric.ratio(F.sum("tat"), F.sum("n_tat")), 0).alias("avg_tat_minutes"))
    risk = readmissions.agg(
        F.count_if(F.col("readmission_risk_tier") == K.RISK_LEVELS[0][1]).alias("high_risk_groups"))
    return side_by_side(labs, risk)


def risk_bubble(readmissions: DataFrame) -> DataFrame:
    hover = F.format_string(
        K.RISK_HOVER, "diagnosis", "age_group", "department",
        labels.plain_number(F.col("readmission_rate_pct"), 1),
        F.format_number(F.round(F.col("avg_cost").cast(numeric.RATIO), 0), 0),
        F.col("total_admissions").cast("string"))
    return (readmissions
            .select("department", "diagnosis", "age_group", "avg_cost", "readmission_rate_pct",
                    "total_admissions", "readmission_risk_tier", hover.alias("hover"))
            .orderBy("department", "diagnosis", "age_group"))


def filter_choices(critical: DataFrame) -> DataFrame:
    """Sorted distinct values of the three filters, each column reduced before the exchange."""
    columns = ["department", "test_name", "lab_status"]
    values = critical.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    return (values.unpivot([], columns, "filter_name", "choice").select("filter_name", "choice")
            .filter(F.col("choice").isNotNull()).distinct().orderBy("filter_name", "choice"))


def critical_labs_filtered(critical: DataFrame, department: str | None = None,
                           test_name: str | None = None,
                           lab_status: str | None = None) -> DataFrame:
    """Table behind the clinical view; ``None`` and ``All`` leave a filter out."""
    rows = critical
    for column, wanted in (("department", department), ("test_name", test_name),
                           ("lab_status", lab_status)):
        if wanted is not None and wanted != "All":
            rows = rows.filter(F.col(column) == wanted)
    return rows.select("lab_id", "patient_id", "department", "attending_doctor", "test_name",
                       "marker", "result_value", "unit", "reference_low", "reference_high",
                       "result_interpretation", "tat_minutes", "lab_status")


def doctor_alert_table(critical: DataFrame, top: int = K.TOP_ALERT_DOCTOR_DEPTS) -> DataFrame:
    per_test = critical.groupBy("attending_doctor", "department", "test_name").agg(
        F.count(F.lit(1)).alias("n"), numeric.exact_sum("tat_minutes").alias("tat"),
        F.count("tat_minutes").alias("n_tat"))
    return (per_test.groupBy("attending_doctor", "department").agg(
        F.sum("n").alias("critical_events"),
        F.count("test_name").alias("distinct_tests"),
        numeric.rounded(numeric.ratio(F.sum("tat"), F.sum("n_tat")), 0).alias("avg_tat_minutes"))
        .orderBy(F.desc("critical_events"), "attending_doctor", "department").limit(top))
