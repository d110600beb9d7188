"""Layer tables as plain file folders.

Two layouts, both written once and never written over:

* batched: ``<table>/_batch_id=<id>/_attempt=<n>/...``. A load writes its own folder, so loads only
  append; repeating one writes the next attempt, and readers take the last complete attempt of
  every batch.
* versioned: ``<table>/_version=<id>/_attempt=<n>/...``. A rebuild writes a new folder. The stages
  of a run read the version of their own run; everyone else reads what a run has published.

Complete is what carries the committer's success marker. Publishing writes one small file that
names the folder of every table of a run, after its checks; the newest such file decides, so
readers see the tables of one run together, or still those of the run before.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

PUBLISHED = "_published"


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    # --- writing ---------------------------------------------------------

    def write_batch(self, rows: DataFrame, table: str, batch_id: str,
                    partition_by: list[str] | None = None, **metrics) -> dict[str, int]:
        return self._write(rows.drop("_batch_id"), table, f"_batch_id={batch_id}",
                           partition_by or [], metrics)

    def write_version(self, rows: DataFrame, table: str, version: str,
                      partition_by: list[str] | None = None, **metrics) -> dict[str, int]:
        return self._write(rows, table, f"_version={version}", partition_by or [], metrics)

    def _write(self, rows: DataFrame, table: str, folder: str, partition_by: list[str],
               metrics: dict) -> dict[str, int]:
        """Write once; the row counts are taken on the way, not by reading back.

        Partitioned writes are rebalanced first: without it every task writes a file into every
        folder. Rebalancing splits a folder that holds much of the table over many tasks and
        merges small ones, which a plain repartition by the folder columns would not.
        """
        target = f"{self.path(table)}/{folder}/_attempt={self._next_attempt(table, folder):06d}"
        if partition_by:
            rows = rows.hint("rebalance", *partition_by)
        seen = Observation()
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"),
                            *[m.alias(name) for name, m in metrics.items()])
        rows.write.mode("error").partitionBy(*partition_by).parquet(target)
        return seen.get

    def publish(self, run: str, tables: list[str]) -> None:
        """Name the folders of this run's tables as the ones to read, all in one step."""
        content = json.dumps({t: self._folder(t, f"_version={run}") for t in tables})
        name = f"{time.time_ns():020d}-{run}.json"
        fs, target = self._handle(f"{self.path(PUBLISHED)}/{name}")
        _, draft = self._handle(f"{self.path(PUBLISHED)}/.{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(content, "utf-8"))
        out.close()
        if not fs.rename(draft, target):
            raise OSError(f"could not publish {name}")

    # --- reading ---------------------------------------------------------

    def read_batches(self, table: str, ddl: str) -> DataFrame:
        """The last complete attempt of every batch, under a declared schema."""
        folders = [self._folder(table, name) for name in self._children(table)
                   if name.startswith("_batch_id=")]
        paths = [f"{self.path(table)}/{f}" for f in folders if f]
        if not paths:
            return self.spark.createDataFrame([], ddl)
        return (self.spark.read.schema(f"{ddl}, _attempt string")
                .option("basePath", self.path(table)).parquet(*paths).drop("_attempt"))

    def read(self, table: str, ddl: str | None = None, version: str | None = None) -> DataFrame:
        """The published folder of a table, or the last complete attempt of ``version``."""
        folder = self.published().get(table) if version is None else self._folder(
            table, f"_version={version}")
        if folder is None:
            what = "published" if version is None else f"complete, of {version},"
            raise FileNotFoundError(f"nothing {what} of {table} under {self.root}")
        reader = self.spark.read.schema(ddl) if ddl else self.spark.read
        return reader.parquet(f"{self.path(table)}/{folder}")

    def published(self) -> dict[str, str]:
        """Folder by table, of the last run that was published."""
        names = self._markers()
        return self._marker(names[-1]) if names else {}

    def versions(self, table: str) -> list[str]:
        """Complete folders of a versioned table."""
        return sorted(f for f in (self._folder(table, name) for name in self._children(table)
                                  if name.startswith("_version=")) if f)

    def exists(self, table: str) -> bool:
        return self._exists(self.path(table))

    def has_version(self, table: str, version: str) -> bool:
        return self._folder(table, f"_version={version}") is not None

    def expire(self, keep: int = 2) -> list[str]:
        """Delete what only runs before the last ``keep`` published ones use; returns the folders.

        Unpublished folders stay: a run may be at work on them.
        """
        if keep < 1:
            raise ValueError("keep at least one run")
        old, kept = self._markers()[:-keep], self._markers()[-keep:]
        used = {item for name in kept for item in self._marker(name).items()}
        gone = sorted({item for name in old for item in self._marker(name).items()} - used)
        for table, folder in gone:
            fs, path = self._handle(f"{self.path(table)}/{folder}")
            fs.delete(path, True)
        for name in old:
            fs, path = self._handle(f"{self.path(PUBLISHED)}/{name}")
            fs.delete(path, False)
        return [f"{table}/{folder}" for table, folder in gone]

    # --- file system -----------------------------------------------------

    def _handle(self, location: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(location)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _exists(self, location: str) -> bool:
        fs, path = self._handle(location)
        return fs.exists(path)

    def _children(self, folder: str) -> list[str]:
        fs, path = self._handle(self.path(folder))
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def _attempts(self, table: str, folder: str) -> list[str]:
        return [n for n in self._children(f"{table}/{folder}") if n.startswith("_attempt=")]

    def _next_attempt(self, table: str, folder: str) -> int:
        return 1 + max([int(n.removeprefix("_attempt=")) for n in self._attempts(table, folder)],
                       default=0)

    def _folder(self, table: str, folder: str) -> str | None:
        """The last complete attempt, None if there is none."""
        done = [n for n in self._attempts(table, folder)
                if self._exists(f"{self.path(table)}/{folder}/{n}/_SUCCESS")]
        return f"{folder}/{done[-1]}" if done else None

    def _markers(self) -> list[str]:
        return [n for n in self._children(PUBLISHED) if n.endswith(".json")
                and not n.startswith(".")]

    def _marker(self, name: str) -> dict[str, str]:
        text = self.spark.read.option("wholetext", True).text(f"{self.path(PUBLISHED)}/{name}")
        return json.loads(text.first()[0])
