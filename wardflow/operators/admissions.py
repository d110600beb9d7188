"""Silver admissions: typed, standardized, derived and flagged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow import constants as K
from wardflow.functions import labels, numeric, parsing, rules
from wardflow.operators.dedup import latest_per_key


def typed(bronze: DataFrame) -> DataFrame:
    """Parse and cast; whatever does not parse becomes NULL and is flagged later.

    ``_unparsed_age`` and ``_unparsed_cost`` tell text that is no number from a missing one.
    """
    age, cost = numeric.whole_number("age"), F.col("total_cost_usd").try_cast(numeric.MONEY)
    return bronze.withColumns({
        "admission_date": parsing.iso_date("admission_date"),
        "discharge_date": parsing.iso_date("discharge_date"),
        "age": age,
        "num_procedures": numeric.whole_number("num_procedures"),
        "readmission": F.col("readmission").try_cast("boolean"),
        "icu_stay": F.col("icu_stay").try_cast("boolean"),
        "total_cost_usd": cost,
        "_unparsed_age": F.col("age").isNotNull() & age.isNull(),
        "_unparsed_cost": F.col("total_cost_usd").isNotNull() & cost.isNull(),
    })


def standardized(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "department": labels.clean_text("department"),
        "diagnosis": labels.clean_text("diagnosis"),
        "gender": labels.clean_text("gender"),
        "attending_doctor": labels.clean_text("attending_doctor"),
        "insurance_id": F.coalesce("insurance_id", F.lit(K.SELF_PAY)),
        "insurer_name": labels.insurer_or_self_pay("insurer_name"),
    })


def derived(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "length_of_stay_days": F.datediff("discharge_date", "admission_date"),
        "age_group": labels.age_group(),
        "cost_tier": labels.cost_tier(),
        "admission_year": F.year("admission_date"),
        "admission_month": F.month("admission_date"),
        "admission_quarter": labels.quarter_label("admission_date"),
    })


def flagged_admissions(bronze: DataFrame, newest_first: list[str] | None = None,
                       tie_break: list[str] | None = None,
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """Every deduplicated admission with its ``dq_flag``; valid and rejected rows together.

    Text is parsed below the deduplication: typed rows are smaller to shuffle, and nothing above
    the exchange can fold the parsing into the quality filter, which would repeat it per rule.
    ``keep`` names Bronze audit columns that stay.
    """
    if newest_first is None:
        newest_first = ["_ingested_at"] if "_ingested_at" in bronze.columns else []
    parsed = standardized(typed(bronze))
    rows = derived(latest_per_key(parsed, ["admission_id"], newest_first, tie_break))
    return (rows.withColumn("dq_flag", rules.quality_flag(rules.admission_rules()))
            .drop(*{"_source", "_source_file", "_batch_id"} - {*keep}, "_unparsed_age",
                  "_unparsed_cost"))


def with_lineage(rows: DataFrame, batch_id: str, processed_at: Column | None = None) -> DataFrame:
    return rows.withColumns({
        "_silver_processed_at": F.current_timestamp() if processed_at is None else processed_at,
        "_silver_batch_id": F.lit(batch_id),
    })
