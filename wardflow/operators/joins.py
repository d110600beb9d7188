"""Ways to put aggregates together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def on_group_keys(left: DataFrame, right: DataFrame, keys: list[str],
                  how: str = "left") -> DataFrame:
    """Join two aggregates of the same rows on their group keys; NULL matches NULL."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same: Column = reduce(lambda a, b: a & b,
                          [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def aggregate_with_distincts(rows: DataFrame, keys: list[str], measures: list[Column],
                             distincts: dict[str, str]) -> DataFrame:
    """Grouped measures plus exact distinct counts, ``{output name: counted column}``.

    One distinct count shares the aggregate of the measures, which reduces to one row per group
    and counted value before the shuffle. Two or more in one aggregate would copy every input row
    for each, so then every count is a pass of its own over the group keys and its column, and
    the results meet again on group keys, a handful of rows.
    """
    if len(distincts) == 1:
        (name, column), = distincts.items()
        return rows.groupBy(*keys).agg(*measures, F.count_distinct(column).alias(name))
    result = rows.groupBy(*keys).agg(*measures)
    for name, column in distincts.items():
        counts = rows.groupBy(*keys).agg(F.count_distinct(column).alias(name))
        result = on_group_keys(result, counts, keys)
    return result


def side_by_side(*totals: DataFrame) -> DataFrame:
    """One row holding the columns of several one-row aggregates, whose names must differ."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), totals)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
