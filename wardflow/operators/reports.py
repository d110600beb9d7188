"""Summaries over Silver and Gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow import constants as K
from wardflow.functions import numeric


def silver_dept_stats(admissions: DataFrame) -> DataFrame:
    return admissions.groupBy("department").agg(
        F.count(F.lit(1)).alias("admissions"),
        numeric.mean("length_of_stay_days", 2).alias("avg_los"),
        numeric.mean("total_cost_usd", 0).alias("avg_cost_usd"),
        numeric.mean("age", 1).alias("avg_age"),
        numeric.count_true("readmission").alias("readmissions"),
    ).orderBy("department")


def interpretation_distribution(labs: DataFrame) -> DataFrame:
    return (labs.groupBy("result_interpretation", "is_critical")
            .agg(F.count(F.lit(1)).alias("results"))
            .orderBy("result_interpretation", "is_critical"))


def tat_by_test(labs: DataFrame) -> DataFrame:
    return (labs.groupBy("test_name")
            .agg(numeric.mean_of_doubles("tat_minutes", 1).alias("avg_tat_min"),
                 F.count(F.lit(1)).alias("results"))
            .orderBy("avg_tat_min", "test_name"))


def annual_los_by_dept(kpis: DataFrame) -> DataFrame:
    """Mean of the monthly means, each month counting the same."""
    return (kpis.groupBy("department")
            .agg(numeric.mean_of_doubles("avg_los_days", 2).alias("annual_avg_los"),
                 F.sum("total_admissions").alias("total_admissions"))
            .orderBy(F.desc("annual_avg_los"), "department"))


def revenue_by_dept(finance: DataFrame) -> DataFrame:
    return (finance.groupBy("department")
            .agg(numeric.millions(numeric.revenue_sum("total_revenue_usd"))
                 .alias("total_revenue_millions_usd"))
            .orderBy(F.desc("total_revenue_millions_usd"), "department"))


def critical_by_dept_test(critical: DataFrame, top: int = K.TOP_DEPT_TESTS) -> DataFrame:
    return (critical.groupBy("department", "test_name")
            .agg(F.count(F.lit(1)).alias("critical_results"),
                 numeric.mean_of_doubles("deviation_from_range", 2).alias("avg_deviation"))
            .orderBy(F.desc("critical_results"), "department", "test_name")
            .limit(top))


def annual_dept_summary(kpis: DataFrame) -> DataFrame:
    return (kpis.groupBy("department")
            .agg(F.sum("total_admissions").alias("total_admissions"),
                 numeric.mean_of_doubles("avg_los_days", 2).alias("avg_los"),
                 numeric.mean_of_doubles("readmission_rate_pct", 2).alias("readmission_rate"),
                 numeric.millions(numeric.revenue_sum("total_revenue_usd"))
                 .alias("total_revenue_m"))
            .orderBy("department"))


def high_risk_groups(readmissions: DataFrame, top: int = K.TOP_HIGH_RISK) -> DataFrame:
    return (readmissions.filter(F.col("readmission_risk_tier") == K.RISK_LEVELS[0][1])
            .select("department", "diagnosis", "age_group", "readmission_rate_pct",
                    "total_admissions")
            .orderBy(F.desc("readmission_rate_pct"), F.desc("total_admissions"),
                     "department", "diagnosis", "age_group")
            .limit(top))


def critical_departments(kpis: DataFrame) -> DataFrame:
    return (kpis.filter(F.col("readmission_status") == K.STATUS_LEVELS[0][1])
            .select("department").distinct().orderBy("department"))
