"""Shared plumbing: the folder all executors see, written tables, code shipping, Arrow columns."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PACKAGE_ROOT = Path(__file__).resolve().parent.parent
_SHIPPED: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local one only where the session is local."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="wardflow-shared-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder; nothing is ever written twice to one path."""
    return f"{shared_dir(spark)}/wardflow-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compact: bool = False) -> DataFrame:
    """``df`` as a table in the shared folder.

    Cuts the lineage at a place that survives the loss of an executor, and makes a later join see
    a plain scan on that side, so that adaptive execution may split a hot key. ``compact`` deals
    the rows to files of the advisory size first: for narrow tables that would otherwise become
    one small file for every shuffle partition.
    """
    path = scratch_path(df.sparkSession, name)
    (df.hint("rebalance") if compact else df).write.parquet(path)
    return df.sparkSession.read.schema(nullable(df.schema)).parquet(path)


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path inside it, for a task that reads or writes files of the shared folder."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))
    return pafs.LocalFileSystem(), path


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


#: Set where the cluster's configuration does not. Batches to Python are bounded by bytes, not only
#: by rows, since texts may be long; and small partitions are merged up to the advisory size, so
#: that the many narrow tables of an iterative operator are few files.
SETTINGS = {
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors once, so that Python workers can import it."""
    for name, value in SETTINGS.items():
        if spark.sparkContext.getConf().get(name, None) is None:
            spark.conf.set(name, value)
    key = spark.sparkContext.applicationId
    if key in _SHIPPED:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="wardflow-code-"), "wardflow_llm.zip")
    with zipfile.ZipFile(archive, "w") as out:
        out.write(PACKAGE_ROOT / "__init__.py", f"{PACKAGE_ROOT.name}/__init__.py")
        for file in sorted((PACKAGE_ROOT / "llm").glob("*.py")):
            out.write(file, f"{PACKAGE_ROOT.name}/llm/{file.name}")
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(key)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, **columns: str) -> DataFrame:
    """``df`` reduced to the named columns with the given types; other columns cannot clash."""
    return df.select(*[F.col(f"`{name}`").cast(kind).alias(name)
                       for name, kind in columns.items()])


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column without copying; null reads as empty."""
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, raw, data = column.buffers()
    offsets = np.frombuffer(raw, width)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Runs of whole documents with about ``most`` bytes, at least one document each."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last
        first = last
