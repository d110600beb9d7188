"""Monthly figures as a state that merges: sums per (department, month, days of stay), and the
distinct patients of a month as bitmaps.

A state of some facts and one of others add up to the state of all, so a delivery costs its own
months and never a pass over all facts. Means, rates and deviations follow from whole sums, so
they are the ones a single pass gives. Days of stay are between 0 and 365, which bounds a month's
rows; a bitmap holds 32,768 patients, and a month has as many as the patients seen need.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.functions import labels, numeric
from wardflow.operators.gold import rolling_mean
from wardflow.operators.joins import on_group_keys

GROUP = ["department", "month"]
SUMS = ["n", "readmissions", "icu", "costs", "cost", "ages", "age"]
NUMBER_SLICES = 4096


class MonthlyState(NamedTuple):
    sums: DataFrame  # department, month, days, and the sums of SUMS
    patients: DataFrame  # department, month, bucket, bitmap


def number_patients(patients: DataFrame, known: DataFrame | None = None,
                    slices: int = NUMBER_SLICES) -> DataFrame:
    """``(patient_id, number)``: known numbers stay, new patients get the next ones, without gaps.

    New patients are counted in ``slices`` hash slices; a number is the patient's place in its
    slice behind all slices before. Only the sizes of the slices meet in one task. A missing id
    has no number.
    """
    new = patients.select("patient_id").na.drop().distinct()
    if known is not None:
        new = new.join(known, "patient_id", "left_anti")
    new = new.withColumn("slice", F.pmod(F.xxhash64("patient_id"), F.lit(slices)))
    place = F.row_number().over(Window.partitionBy("slice").orderBy("patient_id"))
    sizes = new.groupBy("slice").agg(F.count(F.lit(1)).alias("size"))
    if known is not None:  # the numbers in use are a slice before all others
        used = known.agg(F.coalesce(F.max("number") + 1, F.lit(0)).alias("size"))
        sizes = sizes.unionByName(used.withColumn("slice", F.lit(-1).cast("long")))
    before = sizes.select("slice", (F.sum("size").over(Window.orderBy("slice"))
                                    - F.col("size")).alias("before"))
    numbered = new.withColumn("place", place).join(before, "slice").select(
        "patient_id", (F.col("before") + F.col("place") - 1).alias("number"))
    if known is None:
        return numbered
    return known.select("patient_id", "number").unionByName(numbered)


def monthly_state(facts: DataFrame, numbers: DataFrame) -> MonthlyState:
    """The state of ``facts``; ``numbers`` has a number for each of their patients."""
    months = facts.withColumn("month", F.trunc("admission_date", "MM"))
    sums = months.groupBy(*GROUP, F.col("length_of_stay_days").alias("days")).agg(
        F.count(F.lit(1)).alias("n"), numeric.count_true("readmission").alias("readmissions"),
        numeric.count_true("icu_stay").alias("icu"), F.count("total_cost_usd").alias("costs"),
        F.sum("total_cost_usd").alias("cost"), F.count("age").alias("ages"),
        F.sum(F.col("age").cast("long")).alias("age"))
    seen = months.select(*GROUP, "patient_id").distinct().join(numbers, "patient_id")
    patients = seen.groupBy(*GROUP, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"))
    return MonthlyState(sums, patients)


def merged(*states: MonthlyState) -> MonthlyState:
    """The state of all facts that some state has; no fact may be in two of them."""
    sums, patients = states[0]
    for state in states[1:]:
        sums, patients = sums.unionByName(state.sums), patients.unionByName(state.patients)
    return MonthlyState(
        sums.groupBy(*GROUP, "days").agg(*[F.sum(c).alias(c) for c in SUMS]),
        patients.groupBy(*GROUP, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap")))


def replaced_months(state: MonthlyState, months: DataFrame, fresh: MonthlyState) -> MonthlyState:
    """``state`` with the months of ``months(department, month)`` taken from ``fresh`` instead."""
    def others(rows: DataFrame) -> DataFrame:
        named = months.select(*[F.col(c).alias(f"_{c}") for c in GROUP]).distinct()
        return rows.join(named, F.col("department").eqNullSafe(F.col("_department"))
                         & F.col("month").eqNullSafe(F.col("_month")), "left_anti")
    return MonthlyState(others(state.sums).unionByName(fresh.sums),
                        others(state.patients).unionByName(fresh.patients))


def kpis_from_state(state: MonthlyState) -> DataFrame:
    """What ``gold.dept_monthly_kpis`` gives for the facts of the state."""
    days, n = F.col("days"), F.col("n")
    stays = F.sum(F.when(days.isNotNull(), n))
    total = F.sum(days * n).cast("double")
    squares = F.sum(days.cast("long") * days * n).cast("double")
    spread = F.greatest(squares - total * F.try_divide(total, stays.cast("double")), F.lit(0.0))
    groups = state.sums.groupBy(*GROUP).agg(
        F.sum("n").alias("total_admissions"),
        numeric.rounded(numeric.ratio(total, stays), 2).alias("avg_los_days"),
        numeric.rounded(F.sqrt(F.try_divide(spread, stays.cast("double") - 1)), 2)
        .alias("stddev_los_days"),
        F.min("days").alias("min_los_days"), F.max("days").alias("max_los_days"),
        F.sum("readmissions").alias("readmissions"),
        numeric.share_pct(F.sum("readmissions"), F.sum("n")).alias("readmission_rate_pct"),
        numeric.rounded(numeric.ratio(F.sum("cost"), F.sum("costs")), 2).alias("avg_cost_usd"),
        numeric.rounded_total(F.sum("cost")).alias("total_revenue_usd"),
        numeric.rounded(numeric.ratio(F.sum("age"), F.sum("ages")), 1).alias("avg_patient_age"),
        F.sum("icu").alias("icu_admissions"))
    counted = state.patients.groupBy(*GROUP).agg(
        F.sum(F.bitmap_count("bitmap")).alias("unique_patients"))
    kpis = on_group_keys(groups, counted, GROUP).withColumn(
        "unique_patients", F.coalesce("unique_patients", F.lit(0)))
    figures = [c for c in kpis.columns if c not in GROUP]
    return kpis.select(
        "department", F.date_format("month", "yyyy-MM").alias("year_month"),
        F.year("month").alias("admission_year"),
        labels.quarter_label("month").alias("admission_quarter"), *figures).withColumns({
            "rolling_3mo_avg_los": rolling_mean("avg_los_days", "department", "year_month"),
            "rolling_3mo_readmission_pct": rolling_mean(
                "readmission_rate_pct", "department", "year_month"),
            "readmission_status": labels.readmission_status()})
