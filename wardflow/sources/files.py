"""Parquet, CSV and JSON in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow import constants as K

MALFORMED = "_malformed_line"


def read_csv_lines(spark: SparkSession, path: str | list[str], ddl: str) -> DataFrame:
    """Headed CSV under a declared schema, empty strings as NULL, with ``_malformed_line``.

    Bronze columns are all strings: inferring types would read the input twice and let one odd
    batch change a column's type. Silver casts. A line with more or fewer fields than the header,
    whose fields would stand in the wrong columns, keeps its text in ``_malformed_line``; the
    parser counts fields only while it reads all of them.
    """
    return (spark.read.schema(f"{ddl}, {MALFORMED} string").option("header", True)
            .option("nullValue", "").option("enforceSchema", False)
            .option("columnPruning", False).option("columnNameOfCorruptRecord", MALFORMED)
            .csv(path))


def well_formed(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col(MALFORMED).isNull()).drop(MALFORMED)


def malformed(lines: DataFrame) -> DataFrame:
    """The text of the lines that ``well_formed`` leaves out, and their first field.

    Spark answers no query over a CSV file that reads nothing but the text of bad lines.
    """
    audit = [c for c in lines.columns if c.startswith("_") and c != MALFORMED]
    return lines.filter(F.col(MALFORMED).isNotNull()).select(
        F.col(MALFORMED).alias("raw_line"), F.col(lines.columns[0]).alias("first_field"), *audit)


def read_csv(spark: SparkSession, path: str | list[str], ddl: str) -> DataFrame:
    """The well-formed rows of ``read_csv_lines``."""
    return well_formed(read_csv_lines(spark, path, ddl))


def read_admissions_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_csv(spark, path, K.ADMISSIONS_RAW_DDL)


def read_labs_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_csv(spark, path, K.LABS_RAW_DDL)


def write_csv(table: DataFrame, path: str) -> None:
    """Gold table as headed CSV, for consumers that read files."""
    table.write.mode("overwrite").option("header", True).csv(path)


def write_audit_json(audit: DataFrame, path: str) -> None:
    audit.write.mode("overwrite").option("timestampFormat", K.JSON_TIMESTAMP_FORMAT).json(path)


def read_audit_json(spark: SparkSession, path: str, array: bool = False) -> DataFrame:
    """Audit records, one per line or (``array``) as one JSON array per file."""
    return (spark.read.schema(K.AUDIT_DDL).option("multiLine", array)
            .option("timestampFormat", K.JSON_TIMESTAMP_FORMAT).json(path))
