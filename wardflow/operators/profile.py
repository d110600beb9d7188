"""Which types the text columns of a delivery hold, beside the declared ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.parsing import iso_date, iso_timestamp

# Narrowest first; a column is of the first type that all its filled values have.
KINDS = ["boolean", "long", "decimal", "date", "timestamp"]
PROFILE_DDL = ("rows long, column_name string, declared string, filled long, "
               + ", ".join(f"as_{k} long" for k in KINDS) + ", inferred string, fits boolean")
INTEGER = r"^[+-]?[0-9]{1,18}\z"
DECIMAL = r"^[+-]?[0-9]{1,18}(\.[0-9]+)?\z"


def _holds(column: str, kind: str) -> Column:
    text = F.col(column)
    if kind == "boolean":
        return F.lower(text).isin("true", "false")
    if kind == "long":
        return text.rlike(INTEGER)
    if kind == "decimal":
        return text.rlike(DECIMAL)
    return (iso_date(column) if kind == "date" else iso_timestamp(column)).isNotNull()


def delivery_profile(raw: DataFrame, declared: dict[str, str]) -> DataFrame:
    """One row per column of ``declared`` (its kind by column): how many rows are filled, how many
    hold a value of each kind, the narrowest kind that holds all, and whether that fits.

    One pass: all columns are counted in one aggregate, so a task shuffles a single row. An empty
    or NULL value is not filled; a column without any is of kind ``none`` and fits. A long fits a
    declared decimal, and everything fits a string. An empty delivery gives zero counts.
    """
    texts = raw.select(*[F.trim(F.col(f"`{c}`").cast("string")).alias(c) for c in declared])
    counts = [F.count(F.lit(1)).alias("rows")]
    for number, column in enumerate(declared):
        counts.append(F.count_if(F.col(column) != "").alias(f"filled{number}"))
        counts += [F.count_if(_holds(column, kind)).alias(f"{kind}{number}") for kind in KINDS]
    seen = texts.agg(*counts)
    lines = seen.select("rows", F.inline(F.array(*[F.struct(
        F.lit(column).alias("column_name"), F.lit(kind).alias("declared"),
        F.col(f"filled{number}").alias("filled"),
        *[F.col(f"{k}{number}").alias(f"as_{k}") for k in KINDS])
        for number, (column, kind) in enumerate(declared.items())])))
    inferred = F.when(F.col("filled") == 0, "none")
    for kind in KINDS:
        inferred = inferred.when(F.col(f"as_{kind}") == F.col("filled"), kind)
    fits = F.col("declared").isin("string") | F.col("inferred").isin("none") \
        | (F.col("declared") == F.col("inferred")) \
        | ((F.col("declared") == "decimal") & (F.col("inferred") == "long"))
    return lines.withColumn("inferred", inferred.otherwise("string")).withColumn("fits", fits)


def changed_types(before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns that two profiles infer differently; one that a delivery leaves empty is no change."""
    old = before.filter("inferred != 'none'").select("column_name", F.col("inferred").alias("was"))
    new = after.filter("inferred != 'none'").select("column_name", F.col("inferred").alias("now"))
    return old.join(new, "column_name").filter("was != now")
