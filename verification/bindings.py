"""The supplied tables as hospital data: orders are admissions, line items lab results, events
vital signs. All arithmetic is on integers, so another engine derives the very same rows.

Admissions and labs come out as a CSV would deliver them, text columns with unparseable dates
among them, so every query also exercises parsing and casting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Labs share an id across results; these columns order them completely.
LAB_TIE_BREAK = ["_tiebreak_part", "_tiebreak_supp", "_tiebreak_price"]
DEPARTMENTS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
AS_OF = "2005-01-01 00:00:00"
BATCH = "20240101_020000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return visits.selectExpr(
        "o_orderkey AS admission_id",
        "o_custkey AS patient_id",
        """CASE WHEN o_orderkey % 97 = 0 THEN 'not a date'
                ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS admission_date""",
        """CASE WHEN o_orderkey % 89 = 0 THEN NULL
                ELSE CAST(date_add(CAST(o_orderdate AS DATE), CAST((o_orderkey * 37) % 53 - 4
                     + CASE WHEN o_orderkey % 211 = 0 THEN 400 ELSE 0 END AS INT)) AS STRING)
           END AS discharge_date""",
        "concat(' ', lower(o_orderpriority), ' ') AS department",
        "c_mktsegment AS diagnosis",
        "CAST((o_custkey * 13) % 131 - 4 AS STRING) AS age",
        "CASE WHEN o_custkey % 2 = 0 THEN 'm' ELSE 'F ' END AS gender",
        "concat('dr', lpad(CAST(o_orderkey % 50 AS STRING), 4, '0')) AS attending_doctor",
        """CASE WHEN o_orderkey % 6 = 5 THEN NULL
                ELSE concat('INS', CAST(1000 + o_orderkey % 9000 AS STRING)) END AS insurance_id""",
        """CASE o_orderkey % 6 WHEN 0 THEN 'Aetna' WHEN 1 THEN 'BlueCross'
                WHEN 2 THEN 'UnitedHealth' WHEN 3 THEN 'Cigna' WHEN 4 THEN 'Humana'
           END AS insurer_name""",
        "CAST(o_orderkey % 7 = 0 AS STRING) AS readmission",
        "CAST(o_orderpriority = '1-URGENT' OR o_orderkey % 20 = 0 AS STRING) AS icu_stay",
        "CAST(o_orderkey % 9 AS STRING) AS num_procedures",
        """CAST(CASE WHEN o_orderkey % 401 = 0 THEN CAST(0 AS DECIMAL(16,4))
                ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.12 AS DECIMAL(3,2))
                     AS DECIMAL(16,4)) END AS STRING) AS total_cost_usd""",
    )


def widened(admissions: DataFrame) -> DataFrame:
    """Some doctors' names too long for the warehouse, and some costs too large for it."""
    number = F.col("admission_id")
    return admissions.withColumns({
        "attending_doctor": F.when(number % 53 == 0, F.rpad("attending_doctor", 21, "x"))
        .otherwise(F.col("attending_doctor")),
        "total_cost_usd": F.when(number % 59 == 0, F.lit("123456789.0000").cast("decimal(18,4)"))
        .otherwise(F.col("total_cost_usd"))})


def admission_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every admission delivered twice, the second time with one more procedure. Which delivery
    came last differs from row to row, and equal times go to the later batch."""
    rows = admissions(spark, sf_dir)
    day = "CAST('2024-01-01 00:00:00' AS TIMESTAMP) + make_dt_interval(CAST(admission_id % {} AS INT))"
    first = rows.withColumns({"_ingested_at": F.expr(day.format(3)), "_batch_id": F.lit("1")})
    second = rows.withColumns({
        "num_procedures": (F.col("num_procedures").cast("int") + 1).cast("string"),
        "_ingested_at": F.expr(day.format(5)), "_batch_id": F.lit("2")})
    return first.unionByName(second)


def corrected_deliveries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two deliveries whose survivors are ``admissions``.

    The first lacks a fifth of the rows and has a seventh under a wrong department and day. The
    second brings those, and, late, older versions of an eleventh that must not win.
    """
    rows = admissions(spark, sf_dir)
    n = F.col("admission_id")
    wrong, missing = n % 7 == 0, n % 5 == 0

    def brought(part: DataFrame, day: str, batch: str) -> DataFrame:
        return part.withColumns({"_ingested_at": F.lit(f"{day} 00:00:00").cast("timestamp"),
                                 "_batch_id": F.lit(batch)})

    first = rows.filter(~missing).withColumns({
        "department": F.when(wrong, F.lit(" elsewhere")).otherwise(F.col("department")),
        "admission_date": F.when(wrong, F.lit("1990-01-01")).otherwise(F.col("admission_date"))})
    older = rows.filter((n % 11 == 0) & ~wrong & ~missing).withColumn("num_procedures", F.lit("77"))
    return brought(first, "2024-01-01", "1"), brought(
        rows.filter(wrong | missing), "2024-01-02", "2").unionByName(
        brought(older, "2023-01-01", "2"))


def labs(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    shifted = "CAST(CAST(l_shipdate AS TIMESTAMP) + make_dt_interval(0, CAST({} AS INT)) AS STRING)"
    return results.selectExpr(
        "l_orderkey * 10 + l_linenumber AS lab_id",
        "o_custkey AS patient_id",
        "l_orderkey AS admission_id",
        "l_returnflag AS test_name",
        "concat('M', CAST(l_partkey % 4 AS STRING)) AS marker",
        "CAST(CASE WHEN l_partkey % 20 = 0 THEN NULL ELSE l_quantity END AS STRING) AS result_value",
        "'u' AS unit",
        "CAST(5 + l_partkey % 10 AS STRING) AS reference_low",
        "CAST(25 + l_partkey % 15 AS STRING) AS reference_high",
        "CAST(l_suppkey % 20 = 0 AS STRING) AS is_critical",
        shifted.format("l_partkey % 48") + " AS collected_at",
        shifted.format("l_partkey % 48 + l_suppkey % 26 - 1") + " AS resulted_at",
        "CASE l_linestatus WHEN 'F' THEN 'final' ELSE ' preliminary' END AS lab_status",
        "l_partkey AS _tiebreak_part", "l_suppkey AS _tiebreak_supp",
        "l_extendedprice AS _tiebreak_price",
    )


def vitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "concat('VIT-', CAST(user_id AS STRING), '-', CAST(event_id AS STRING)) AS message_id",
        "CAST(user_id AS STRING) AS patient_id",
        """CASE event_type WHEN 'error' THEN 'ICU' WHEN 'purchase' THEN 'Cardiology'
                WHEN 'signup' THEN 'Neurology' ELSE 'Emergency' END AS department""",
        """date_format(CAST(ts AS TIMESTAMP), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") AS timestamp""",
        "CASE WHEN event_type = 'error' THEN 'deteriorating' ELSE 'stable' END AS patient_state",
        "event_type = 'error' AS is_anomaly",
        "CAST(25 + event_id % 170 AS INT) AS heart_rate",
        "CAST(65 + (event_id * 7) % 145 AS INT) AS systolic_bp",
        "CAST(35 + (event_id * 11) % 95 AS INT) AS diastolic_bp",
        "CAST(80 + (event_id * 3) % 21 AS INT) AS spo2_pct",
        "CAST((340 + (event_id * 13) % 75) / 10.0 AS DOUBLE) AS temperature_c",
        "CAST(4 + (event_id * 5) % 36 AS INT) AS resp_rate",
    )


def vital_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings as a topic delivers them; every fiftieth payload is broken JSON."""
    rows = vitals(spark, sf_dir)
    payload = F.to_json(F.struct(*[c for c in rows.columns if c != "event_id"]))
    return rows.select(
        F.when(F.col("event_id") % 50 == 0, F.lit("{bad")).otherwise(payload)
        .cast("binary").alias("value"))


def insurance_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a dated, cleaned insurance observation of its patient."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS patient_id", "o_orderkey AS admission_id",
        "CAST(o_orderdate AS DATE) AS admission_date",
        "CAST((o_custkey * 13) % 131 - 4 AS INT) AS age",
        "CASE WHEN o_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender",
        """CASE WHEN o_orderkey % 6 = 5 THEN 'SELF_PAY'
                ELSE concat('INS', CAST(1000 + o_orderkey % 9000 AS STRING)) END AS insurance_id""",
        """CASE o_orderkey % 6 WHEN 0 THEN 'AETNA' WHEN 1 THEN 'BLUECROSS'
                WHEN 2 THEN 'UNITEDHEALTH' WHEN 3 THEN 'CIGNA' WHEN 4 THEN 'HUMANA'
                ELSE 'SELF_PAY' END AS insurer_name""",
    )
