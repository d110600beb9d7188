"""Streaming queries: land vitals, land dead letters, raise alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardflow import constants as K
from wardflow.streaming import vitals


def kafka_messages(spark: SparkSession, brokers: str, topic: str = K.VITALS_TOPIC,
                   starting_offsets: str = "latest",
                   max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Stream of one topic. ``max_offsets_per_trigger`` bounds a micro-batch after an outage."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", brokers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def file_messages(spark: SparkSession, folder: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Stream of text files, one message per line, in the shape of a topic."""
    return (spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger)
            .load(folder))


def landed_vitals(spark: SparkSession, path: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Landed vitals as a stream, for an alert job that runs apart from the landing job.

    It reads what the landing job has committed, so alerts trail the topic by one more trigger.
    """
    return (spark.readStream.schema(K.VITALS_LANDED_DDL)
            .option("maxFilesPerTrigger", max_files_per_trigger).parquet(path))


def append_stream(rows: DataFrame, path: str, checkpoint: str, name: str | None = None,
                  fmt: str = "parquet", every: str = K.STREAM_TRIGGER,
                  available_now: bool = False) -> StreamingQuery:
    """Append to files exactly once: the checkpoint and the sink's own log survive restarts.

    ``path`` and ``checkpoint`` belong on shared storage, and each query needs a checkpoint of
    its own.
    """
    writer = (rows.writeStream.format(fmt).outputMode("append")
              .option("checkpointLocation", checkpoint))
    if name:
        writer = writer.queryName(name)
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.trigger(**trigger).start(path)


RAW_DDL = "raw_value string, _ingested_at timestamp"


def land_messages(messages: DataFrame, root: str, checkpoints: str,
                  available_now: bool = False) -> StreamingQuery:
    """Read the topic once and land every message as it came. All else reads what has landed."""
    raw = messages.select(F.col("value").cast("string").alias("raw_value"))
    return append_stream(vitals.with_ingest_time(raw), f"{root}/vitals_raw",
                         f"{checkpoints}/vitals_raw", "vitals_raw", available_now=available_now)


def landed_messages(spark: SparkSession, root: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Landed messages as a stream; before the first has landed, an empty folder is watched."""
    path = f"{root}/vitals_raw"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    return (spark.readStream.schema(RAW_DDL).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path).select(F.col("raw_value").alias("value")))


def start_vitals(messages: DataFrame, root: str, checkpoints: str, fmt: str = "parquet",
                 available_now: bool = False) -> dict[str, StreamingQuery]:
    """Land the topic, then parse, reject and alert from what has landed.

    One query reads the topic, so there is one set of offsets: every vital sign, dead letter and
    alert comes from a message that is kept. The other three trail it by one trigger.
    """
    spark = messages.sparkSession
    landing = land_messages(messages, root, checkpoints, available_now)
    if available_now:
        landing.awaitTermination()
    landed = landed_messages(spark, root)
    parsed = vitals.parse_vitals(landed)
    outputs = {
        "vitals": vitals.with_ingest_time(parsed),
        "vitals_dead_letters": vitals.with_ingest_time(vitals.dead_letters(landed)),
        "vitals_alerts": vitals.with_ingest_time(vitals.vitals_alerts(parsed)),
    }
    return {"vitals_raw": landing, **{
        name: append_stream(rows, f"{root}/{name}", f"{checkpoints}/{name}", name, fmt,
                            available_now=available_now)
        for name, rows in outputs.items()}}


def write_micro_batch(messages: DataFrame, batch: int, root: str) -> None:
    """One micro-batch: parsed once and landed, then its alerts, from what has landed.

    Both folders are named by the batch and replaced as a whole, so a batch that is run again
    after a failure, between the two writes or within one, leaves what one run would have left.
    """
    folder = f"{root}/vitals_messages/micro_batch={batch}"
    vitals.with_ingest_time(vitals.decided(messages)).write.mode("overwrite") \
        .partitionBy("usable").parquet(folder)
    landed = messages.sparkSession.read.schema(LANDED_DDL).parquet(folder)
    alerts = vitals.with_ingest_time(vitals.vitals_alerts(vitals.usable(landed)))
    alerts.write.mode("overwrite").parquet(f"{root}/vitals_alerts/micro_batch={batch}")


LANDED_DDL = (f"raw_value string, {K.VITALS_MESSAGE_DDL}, event_ts timestamp, "
              "_ingested_at timestamp, usable boolean")


def start_vitals_in_one_pass(messages: DataFrame, root: str, checkpoints: str,
                             available_now: bool = False) -> StreamingQuery:
    """Messages, readings, dead letters and alerts by one query, within one trigger.

    ``landed_outputs`` reads them. Against ``start_vitals``, alerts do not wait for a second
    trigger and a message is parsed once; a message that cannot be parsed is kept as text all the
    same.
    """
    def write(rows: DataFrame, batch: int) -> None:
        write_micro_batch(rows, batch, root)
    trigger = {"availableNow": True} if available_now else {"processingTime": K.STREAM_TRIGGER}
    return (messages.writeStream.queryName("vitals_in_one_pass").foreachBatch(write)
            .option("checkpointLocation", f"{checkpoints}/vitals_in_one_pass")
            .trigger(**trigger).start())


def landed_outputs(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """What ``start_vitals_in_one_pass`` has landed so far."""
    landed = spark.read.schema(f"{LANDED_DDL}, micro_batch long").parquet(
        f"{root}/vitals_messages")
    return {"vitals": vitals.usable(landed), "vitals_dead_letters": vitals.unusable(landed),
            "vitals_alerts": spark.read.parquet(f"{root}/vitals_alerts").drop("micro_batch")}


def start_alert_summary(alerts: DataFrame, root: str, checkpoints: str,
                        available_now: bool = False) -> StreamingQuery:
    """Append each day's alert counts once the day is over and late alerts have had their time."""
    return append_stream(vitals.windowed_alert_summary(alerts), f"{root}/alert_summary",
                         f"{checkpoints}/alert_summary", "alert_summary",
                         available_now=available_now)
