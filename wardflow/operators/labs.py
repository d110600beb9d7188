"""Silver lab results: typed, interpreted against the reference range and flagged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions import labels, numeric, parsing, rules
from wardflow.operators.dedup import LAB_KEY, latest_per_key


def typed(bronze: DataFrame) -> DataFrame:
    return bronze.withColumns({
        "collected_at": parsing.iso_timestamp("collected_at"),
        "resulted_at": parsing.iso_timestamp("resulted_at"),
        "result_value": numeric.finite_or_null(F.col("result_value").try_cast("double")),
        "reference_low": numeric.finite_or_null(F.col("reference_low").try_cast("double")),
        "reference_high": numeric.finite_or_null(F.col("reference_high").try_cast("double")),
        "is_critical": F.col("is_critical").try_cast("boolean"),
        "test_name": labels.clean_text("test_name"),
        "lab_status": labels.clean_text("lab_status"),
    })


def derived(rows: DataFrame) -> DataFrame:
    value, low, high = F.col("result_value"), F.col("reference_low"), F.col("reference_high")
    outside = F.greatest(low - value, value - high, F.lit(0.0))
    return rows.withColumns({
        "result_interpretation": labels.interpretation(
            "result_value", "reference_low", "reference_high"),
        "deviation_from_range": F.when(value.isNull(), F.lit(0.0)).otherwise(
            numeric.rounded(outside, 3)),
        "tat_minutes": numeric.rounded(
            numeric.seconds_between("collected_at", "resulted_at") / 60, 1),
    })


def flagged_labs(bronze: DataFrame, keys: list[str] | None = None,
                 newest_first: list[str] | None = None,
                 tie_break: list[str] | None = None,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Every deduplicated result with its ``dq_flag``.

    The default key is (lab_id, marker): all markers of a panel share one lab_id, and keying on
    lab_id alone would throw away all but one of them. As with admissions, parsing comes first.
    """
    if newest_first is None:
        newest_first = ["_ingested_at"] if "_ingested_at" in bronze.columns else []
    rows = derived(latest_per_key(typed(bronze), keys or LAB_KEY, newest_first, tie_break))
    return (rows.withColumn("dq_flag", rules.quality_flag(rules.lab_rules()))
            .drop(*{"_source", "_source_file", "_batch_id"} - {*keep}))
