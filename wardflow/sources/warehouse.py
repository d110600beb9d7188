"""Export of Silver admissions under the warehouse's column contract.

A row goes out whole or not at all: one with a value that does not fit its column is a reject,
with the columns named, and nothing is shortened or emptied on the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from wardflow import constants as K


def _fields() -> list[StructField]:
    return StructType.fromDDL(K.WAREHOUSE_DDL).fields


def _value(field: StructField) -> Column:
    return F.col(field.name).try_cast(field.dataType)


def _misfit(field: StructField) -> Column:
    lost = F.col(field.name).isNotNull() & _value(field).isNull()
    width = K.WAREHOUSE_WIDTHS.get(field.name)
    return lost | F.coalesce(F.char_length(_value(field)) > width, F.lit(False)) if width else lost


def _misfits() -> Column:
    """Names of the columns whose value does not fit, empty for a row that can be loaded."""
    return F.filter(F.array(*[F.when(_misfit(f), f.name) for f in _fields()]),
                    lambda name: name.isNotNull())


def warehouse_export(admissions: DataFrame) -> DataFrame:
    """The 23 contract columns of every row that fits them."""
    return admissions.filter(F.size(_misfits()) == 0).select(
        *[_value(f).alias(f.name) for f in _fields()])


def warehouse_rejects(admissions: DataFrame) -> DataFrame:
    """The other rows, unchanged, with ``misfit_columns``."""
    return admissions.withColumn("misfit_columns", F.array_join(_misfits(), ", ")).filter(
        F.col("misfit_columns") != "")


def write_jdbc(export: DataFrame, url: str, table: str, properties: dict[str, str],
               connections: int = 16) -> None:
    """Load the export into a database table over ``connections`` connections.

    The rows are dealt out evenly to that many writers by an exchange of their own, so the
    stages above keep their width. The number is what the database allows, not a property of the
    data.
    """
    (export.repartition(connections).write.mode("overwrite").option("truncate", True)
     .option("batchsize", 10_000).jdbc(url, table, properties=properties))
