"""Silver kept up to date: what a delivery changes, and what its partitions hold afterwards.

Rows are versions of their key, and the newest version is the one that counts, whichever delivery
brought it. So the rows of the delivered keys, old and new, decide among themselves, and all other
rows stay. Only partitions that hold or will hold a row of a delivered key change.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.operators.dedup import latest_per_key


class Merge(NamedTuple):
    """What a delivery does to a table; nothing has run yet."""

    replaced: DataFrame  # all rows of the touched partitions afterwards
    before: DataFrame  # the rows that the delivery's keys had
    after: DataFrame  # the rows that they have now


def _matches(keys: list[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k) == F.col(f"{prefix}{k}") for k in keys])


def _with_keys(rows: DataFrame, keys: DataFrame, columns: list[str], how: str) -> DataFrame:
    renamed = keys.withColumnsRenamed({c: f"_delivered_{c}" for c in columns})
    return rows.join(renamed, _matches(columns, "_delivered_"), how)


def _keyless(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def of_delivery(current: DataFrame, delivered: DataFrame, keys: list[str],
                batch: str = "_batch_id") -> DataFrame:
    """Current rows that a delivery may replace: those of its keys, and its own without a key.

    The join is on the keys alone and asks nothing of the current side but its bucketing by them.
    """
    named = delivered.select(*keys).na.drop().distinct()
    batches = delivered.select(F.col(batch).alias("_delivered_batch")).distinct()
    own = current.filter(_keyless(keys)).join(
        batches, F.col(batch) == F.col("_delivered_batch"), "left_semi")
    return _with_keys(current, named, keys, "left_semi").unionByName(own)


def touched_partitions(current: DataFrame, delivered: DataFrame, keys: list[str],
                       partition_by: list[str], batch: str = "_batch_id") -> DataFrame:
    """Distinct partition values that hold a row of the delivery's keys, or will."""
    narrow = list(dict.fromkeys([*keys, *partition_by, batch]))
    old = of_delivery(current.select(*narrow), delivered.select(*narrow), keys, batch)
    return old.select(*partition_by).union(delivered.select(*partition_by)).distinct()


def in_partitions(rows: DataFrame, partitions: list[dict]) -> DataFrame:
    """Rows of the named partitions, by a filter that prunes folders."""
    if not partitions:
        return rows.filter(F.lit(False))
    same = [reduce(lambda a, b: a & b, [F.col(c).isNull() if v is None else F.col(c) == F.lit(v)
                                        for c, v in values.items()]) for values in partitions]
    return rows.filter(reduce(lambda a, b: a | b, same))


def merge_delivery(touched: DataFrame, delivered: DataFrame, keys: list[str],
                   newest_first: list[str], batch: str = "_batch_id") -> Merge:
    """Merge ``delivered`` into the current rows ``touched`` of the partitions it touches.

    Repeating a delivery changes nothing: its rows meet themselves, and those without a key
    replace the ones it brought before. ``newest_first`` has to order the versions of a key
    completely, the batch included.
    """
    before = of_delivery(touched, delivered, keys, batch)
    named = before.filter(~_keyless(keys))
    after = latest_per_key(named.unionByName(delivered), keys, newest_first)
    gone = delivered.select(*keys).na.drop().distinct()
    batches = delivered.select(F.col(batch).alias("_delivered_batch")).distinct()
    # A NULL key matches no delivered key, so keyless rows stay here unless their batch is back.
    others = _with_keys(touched.filter(~_keyless(keys)), gone, keys, "left_anti").unionByName(
        touched.filter(_keyless(keys)).join(
            batches, F.col(batch) == F.col("_delivered_batch"), "left_anti"))
    return Merge(others.unionByName(after), before, after)
