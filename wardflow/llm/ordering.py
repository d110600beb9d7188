"""Global ranks without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.common import written

#: ``monotonically_increasing_id`` keeps the row number of a partition in its lower bits.
ROW_BITS = 33


def ranked(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with ``rank``, 0, 1, 2 ... in a total order over the whole table.

    The rows are dealt into ranges and sorted there; a row's place in its range plus the size of
    all ranges before it is its rank. Only the sizes, one number per range, meet in one task. The
    sorted table is written, so the places hold when a task is run again.
    """
    placed = written(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                     .withColumn("_place", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("_range", F.shiftright("_place", ROW_BITS))
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_range")) - F.col("_size")
    starts = sizes.select("_range", before.alias("_before"))
    local = F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (placed.join(starts, "_range").withColumn("rank", F.col("_before") + local)
            .drop("_place", "_range", "_before"))
