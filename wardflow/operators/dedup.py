"""Keep one row per key, chosen by a total order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LAB_KEY = ["lab_id", "marker"]
LAB_KEY_COMPAT = ["lab_id"]


def latest_per_key(rows: DataFrame, keys: list[str], newest_first: list[str],
                   tie_break: list[str] | None = None) -> DataFrame:
    """The newest row of each key; ties go to the smallest ``tie_break`` values.

    Without ``tie_break`` a hash of every remaining column decides, worked out below the exchange:
    only rows equal in every column can tie, the survivor does not depend on how the input is
    partitioned, and a consumer that reads three columns shuffles three and the hash.

    A row without a key, or with part of it missing, is no version of any other row: each one
    stays, for the quality rules to reject, and each is a group of its own.

    The filter on ``row_number`` plans as a group limit on both sides of the exchange: each task
    sends at most one row per key, so a key that holds a third of the table costs no more to
    shuffle than any other.
    """
    rest = [c for c in rows.columns if c not in keys and c not in newest_first]
    if tie_break is not None:
        ties = [F.col(c).asc_nulls_first() for c in tie_break]
    else:
        ties = [F.col("_row_hash")] if rest else []
        rows = rows.withColumn("_row_hash", F.xxhash64(*rest)) if rest else rows
    keyless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    order = [F.col(c).desc_nulls_last() for c in newest_first] + ties or [F.lit(1)]
    rank = F.row_number().over(Window.partitionBy(*keys, "_keyless").orderBy(*order))
    return (rows.withColumn("_keyless", F.when(keyless, F.monotonically_increasing_id()))
            .withColumn("_rank", rank).filter(F.col("_rank") == 1)
            .drop("_rank", "_row_hash", "_keyless"))
