"""Bronze: raw rows plus audit columns, and the checks run after a load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def audit_columns(raw: DataFrame, batch_id: str, source: str,
                  ingested_at: Column | None = None, source_file: bool = False) -> DataFrame:
    """Add when, in which batch and from which source a row arrived.

    ``source_file`` adds the file path and works only directly above a file scan.
    """
    columns = {
        "_ingested_at": F.current_timestamp() if ingested_at is None else ingested_at,
        "_batch_id": F.lit(batch_id),
        "_source": F.lit(source),
    }
    if source_file:
        columns["_source_file"] = F.col("_metadata.file_path")
    return raw.withColumns(columns)


def write_verify(table: DataFrame, partition_column: str) -> DataFrame:
    """Row count and number of distinct partition values.

    Counted per partition value first, so only one row per value and task is shuffled and no
    value, however common, gathers its rows in one task.
    """
    per_value = table.groupBy(partition_column).agg(F.count(F.lit(1)).alias("rows"))
    return per_value.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                         F.count(partition_column).alias("partitions"))


def load_history(table: DataFrame, last: int = 3) -> DataFrame:
    """The most recent loads of an append-only table."""
    return (table.groupBy("_batch_id")
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.min("_ingested_at").alias("first_ingested_at"),
                 F.max("_ingested_at").alias("last_ingested_at"))
            .orderBy(F.desc("last_ingested_at"), F.desc("_batch_id"))
            .limit(last))
