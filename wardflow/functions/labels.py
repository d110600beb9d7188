"""Text cleaning, banding and display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardflow import constants as K


def clean_text(column: str | Column) -> Column:
    return F.upper(F.trim(F.col(column) if isinstance(column, str) else column))


def insurer_or_self_pay(column: str) -> Column:
    """Missing and literally unknown insurers are both self-paying."""
    name = clean_text(F.coalesce(F.col(column), F.lit(K.UNKNOWN_INSURER)))
    return F.when(name == K.UNKNOWN_INSURER, F.lit(K.SELF_PAY)).otherwise(name)


def banded(column: str, bands: list[tuple[float, str]], beyond: str) -> Column:
    """Label of the first band whose exclusive upper bound exceeds the value."""
    bound, label = bands[0]
    chain = F.when(F.col(column) < bound, label)
    for bound, label in bands[1:]:
        chain = chain.when(F.col(column) < bound, label)
    return chain.otherwise(beyond)


def levelled(column: str, levels: list[tuple[float, str]], below: str) -> Column:
    """Label of the first level the value strictly exceeds."""
    bound, label = levels[0]
    chain = F.when(F.col(column) > bound, label)
    for bound, label in levels[1:]:
        chain = chain.when(F.col(column) > bound, label)
    return chain.otherwise(below)


def age_group(column: str = "age") -> Column:
    return banded(column, K.AGE_BANDS, K.AGE_BEYOND)


def cost_tier(column: str = "total_cost_usd") -> Column:
    return banded(column, K.COST_BANDS, K.COST_BEYOND)


def risk_tier(column: str = "readmission_rate_pct") -> Column:
    return levelled(column, K.RISK_LEVELS, K.RISK_BELOW)


def readmission_status(column: str = "readmission_rate_pct") -> Column:
    return levelled(column, K.STATUS_LEVELS, K.STATUS_BELOW)


def quarter_label(column: str) -> Column:
    return F.concat(F.lit("Q"), F.quarter(column).cast("string"))


def interpretation(value: str, low: str, high: str) -> Column:
    """LOW / HIGH / NORMAL against the reference range; UNKNOWN without a value."""
    return (F.when(F.col(value).isNull(), "UNKNOWN")
            .when(F.col(value) < F.col(low), "LOW")
            .when(F.col(value) > F.col(high), "HIGH")
            .otherwise("NORMAL"))


def tier_rank(column: str = "cost_tier") -> Column:
    """Position in the fixed tier order; anything unknown sorts last."""
    position = F.array_position(F.array(*[F.lit(t) for t in K.COST_TIER_ORDER]), F.col(column))
    return F.when(position > 0, position).otherwise(F.lit(len(K.COST_TIER_ORDER) + 1))


def plain_number(value: Column, scale: int) -> Column:
    """Rounded number as text, without a trailing ``.0``."""
    text = F.round(value.cast("decimal(28,6)"), scale).cast("string")
    return F.regexp_replace(text, r"\.0+$", "")


def magnitude_label(value: Column, prefix: str = "", scale: int = 1) -> Column:
    """Short label: millions as M, thousands as K, an en dash when there is no number."""
    number = value.cast("double")
    text = (F.when(F.abs(number) >= 1e6, F.concat(plain_number(number / 1e6, scale), F.lit("M")))
            .when(F.abs(number) >= 1e3, F.concat(plain_number(number / 1e3, scale), F.lit("K")))
            .otherwise(plain_number(number, scale)))
    return F.coalesce(F.concat(F.lit(prefix), text), F.lit(K.NO_VALUE))
