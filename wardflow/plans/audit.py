"""Records in and out of every step, from the tables or from the audit log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow import constants as K
from wardflow.operators.joins import side_by_side


def audit_row(spark: SparkSession, step: str, layer: str, status: str, records_in: int,
              records_out: int, elapsed_sec: int, notes: str = "") -> DataFrame:
    """One audit record as a one-row DataFrame, ready to append."""
    return spark.range(1).select(
        F.lit(step).alias("step"), F.lit(layer).alias("layer"), F.lit(status).alias("status"),
        F.lit(records_in).cast("bigint").alias("records_in"),
        F.lit(records_out).cast("bigint").alias("records_out"),
        F.lit(elapsed_sec).cast("bigint").alias("elapsed_sec"),
        F.lit(notes).alias("notes"), F.current_timestamp().alias("finished_at"))


def _counts(rows: DataFrame, **measures) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("rows"),
                    *[m.alias(name) for name, m in measures.items()])


def layer_reconciliation(bronze_admissions: DataFrame, bronze_labs: DataFrame,
                         flagged_admissions: DataFrame, flagged_labs: DataFrame,
                         gold: dict[str, DataFrame], from_labs: set[str]) -> DataFrame:
    """Records in and out of the eight steps, recounted from the tables themselves.

    Each input is counted once; the steps are then laid out from those single rows. ``gold``
    maps step name to table; the steps in ``from_labs`` read Silver labs, the others admissions.
    """
    valid = F.count_if(F.col("dq_flag") == K.VALID)
    counts = [
        _counts(bronze_admissions).withColumnRenamed("rows", "bronze_adm"),
        _counts(bronze_labs).withColumnRenamed("rows", "bronze_lab"),
        _counts(flagged_admissions, adm=valid,
                rejected=F.count_if(F.col("dq_flag") != K.VALID)).drop("rows"),
        _counts(flagged_labs, lab=valid).drop("rows"),
        *[_counts(t).withColumnRenamed("rows", f"out_{n}") for n, t in gold.items()],
    ]
    wide = side_by_side(*counts)

    def step(name, layer, records_in, records_out, notes=None):
        return F.struct(
            F.lit(name).alias("step"), F.lit(layer).alias("layer"),
            F.lit("success").alias("status"), F.col(records_in).alias("records_in"),
            F.col(records_out).alias("records_out"),
            (F.lit("") if notes is None else notes).alias("notes"))

    steps = [
        step("ingest_admissions", "bronze", "bronze_adm", "bronze_adm"),
        step("ingest_labs", "bronze", "bronze_lab", "bronze_lab"),
        step("transform_admissions", "silver", "bronze_adm", "adm",
             F.concat(F.lit("quarantined="), F.col("rejected").cast("string"))),
        step("transform_labs", "silver", "bronze_lab", "lab"),
        *[step(n, "gold", "lab" if n in from_labs else "adm", f"out_{n}") for n in gold],
    ]
    return records_flow(wide.select(F.inline(F.array(*steps))))


def records_flow(audit: DataFrame) -> DataFrame:
    """Audit rows with what each step dropped."""
    return audit.withColumn("dropped", F.col("records_in") - F.col("records_out"))


def audit_kpis(audit: DataFrame) -> DataFrame:
    measures = [F.count(F.lit(1)).alias("steps"), F.sum("records_in").alias("records_in"),
                F.sum("records_out").alias("records_out")]
    if "finished_at" in audit.columns:
        measures.append(F.max("finished_at").alias("last_run"))
    return audit.agg(*measures)
