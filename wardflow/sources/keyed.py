"""Tables that are kept up to date in place: partitioned into folders, bucketed by their key.

Buckets let a delivery meet the table on its key without moving the table: only the delivery is
exchanged. A write replaces the partitions it has rows of and no others. Each partition changes
in the moment its files are committed, so a run that dies may leave some partitions old and some
new; merging the same delivery again brings all of them to the same state.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardflow.operators import incremental


@dataclass
class KeyedTable:
    """``buckets`` should not be below ``spark.sql.shuffle.partitions``: the planner then keeps the
    table's own distribution."""

    spark: SparkSession
    path: str
    ddl: str
    keys: list[str]
    partition_by: list[str]
    buckets: int = 2000
    newest_first: list[str] = field(default_factory=lambda: ["_ingested_at", "_batch_id"])

    def __post_init__(self):
        self.name = "keyed_" + hashlib.sha1(self.path.encode()).hexdigest()[:16]
        keys = ", ".join(self.keys)
        setting = "spark.sql.hive.manageFilesourcePartitions"
        tracked = self.spark.conf.get(setting)
        # Folders are listed, not kept in a catalog that other sessions do not share.
        self.spark.conf.set(setting, "false")
        try:
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name} ({self.ddl}) USING parquet "
                f"OPTIONS (partitionOverwriteMode 'dynamic') "
                f"PARTITIONED BY ({', '.join(self.partition_by)}) "
                f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS "
                f"LOCATION '{self.path}'")
        finally:
            self.spark.conf.set(setting, tracked)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def merge(self, delivered: DataFrame,
              first: Callable[[incremental.Merge], None] | None = None) -> dict[str, int]:
        """Merge a delivery into the partitions it touches; returns what was read and written.

        ``first`` sees the rows before and after while the table is still as it was. Only the
        partitions touched, at most as many as there are folders, reach the driver.
        """
        self.spark.catalog.refreshTable(self.name)
        current = self.read()
        staged = f"{self.path}_delivered/{uuid.uuid4().hex}"
        delivered.select(*current.columns).write.parquet(staged)  # parsed once, read many times
        delivered = self.spark.read.schema(current.schema).parquet(staged)
        found = incremental.touched_partitions(current, delivered, self.keys, self.partition_by)
        touched = [row.asDict() for row in found.toLocalIterator()]
        base = incremental.in_partitions(current, touched)
        merge = incremental.merge_delivery(base, delivered, self.keys, self.newest_first)
        if first:
            first(merge)
        counts = self._counts(base, merge)

        # A task per bucket, so that a folder gets a file per bucket and not one per task and
        # bucket. Rows without a key would all be of one bucket; they stay where they are.
        rows = merge.replaced.select(*current.columns)
        keyless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in self.keys])
        seen = Observation()
        (rows.filter(~keyless).repartition(self.buckets, *self.keys).union(rows.filter(keyless))
         .observe(seen, F.count(F.lit(1)).alias("rows"))
         .write.mode("overwrite").insertInto(self.name))
        for row in counts:
            if row["folder"] and not row["after"]:  # nothing to write, so nothing was replaced
                self._delete(row["folder"])
        self._delete(staged)
        self.spark.catalog.refreshTable(self.name)
        return {"partitions": len(touched), "read": sum(r["before"] for r in counts),
                "rows": seen.get["rows"]}

    def _delete(self, folder: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def _counts(self, base: DataFrame, merge: incremental.Merge) -> list[dict]:
        """Rows of each touched partition before and after, and its folder if it has one."""
        folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
        none = F.lit(None).cast("string")

        def signed(rows: DataFrame, was: int, will: int, where=none) -> DataFrame:
            return rows.select(*self.partition_by, F.lit(was).alias("was"),
                               F.lit(will).alias("will"), where.alias("folder"))

        every = signed(base, 1, 1, folder).union(signed(merge.before, 0, -1)).union(
            signed(merge.after, 0, 1))
        return [r.asDict() for r in every.groupBy(*self.partition_by).agg(
            F.sum("was").alias("before"), F.sum("will").alias("after"),
            F.max("folder").alias("folder")).toLocalIterator()]
