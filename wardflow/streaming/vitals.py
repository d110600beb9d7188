"""Parse vital-sign messages and raise alerts. Every function is a row-wise map, so it runs
unchanged on a batch and on a stream, without state or shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow import constants as K

_CORRUPT = "_corrupt"


# Fixed value: the accepted form of a message time, with an optional fraction and offset.
ISO_INSTANT = (r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,9})?"
               r"(Z|[+-]\d{2}:?\d{2})?\z")
_FIELDS = [line.split()[0] for line in K.VITALS_MESSAGE_DDL.split(",")]


def _event_time(text: Column) -> Column:
    """The instant of a full ISO time; "12:30" or "noon" name none that could be repeated."""
    return F.when(text.rlike(ISO_INSTANT), F.try_to_timestamp(text))


def _decoded(messages: DataFrame) -> DataFrame:
    """Message fields and the event time next to the raw text.

    The struct goes through ``inline``, so that message and time are worked out once per message;
    as plain columns they would be again in every filter and projection that reads a field.
    """
    text = F.col("value").cast("string")
    schema = f"{K.VITALS_MESSAGE_DDL}, {_CORRUPT} string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    decoded = F.transform(F.array(F.from_json(text, schema, options)), lambda m: F.struct(
        *[m[c].alias(c) for c in [*_FIELDS, _CORRUPT]],
        _event_time(m["timestamp"]).alias("event_ts")))
    return messages.select(text.alias("raw_value"), F.inline(decoded))


def _usable() -> Column:
    """Well-formed, every field of its type, with an identity to land the reading under, and a
    time, if any is given, that is one."""
    return (F.col(_CORRUPT).isNull() & F.col("message_id").isNotNull()
            & F.col("patient_id").isNotNull()
            & (F.col("timestamp").isNull() | F.col("event_ts").isNotNull()))


def decided(messages: DataFrame) -> DataFrame:
    """Every message parsed once: raw text, fields, event time, and whether it is ``usable``."""
    return _decoded(messages).withColumn("usable", _usable()).drop(_CORRUPT)


def usable(messages: DataFrame) -> DataFrame:
    """The usable ones of ``decided`` messages, as ``parse_vitals`` gives them."""
    return messages.filter(F.col("usable")).select(*_FIELDS, "event_ts")


def unusable(messages: DataFrame) -> DataFrame:
    return messages.filter(~F.col("usable")).select("raw_value")


def parse_vitals(messages: DataFrame) -> DataFrame:
    """Usable messages of a source with a ``value`` column, flattened and typed.

    ``timestamp`` keeps the text a message came with.
    """
    return usable(decided(messages))


def dead_letters(messages: DataFrame) -> DataFrame:
    """Messages ``parse_vitals`` leaves out, with their raw text."""
    return unusable(decided(messages))


def with_ingest_time(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_ingested_at", F.current_timestamp())


def _severity(vital: str, ranges: tuple[float, float, float, float]) -> Column:
    low, high, critical_low, critical_high = ranges
    value = F.col(vital)
    return (F.when((value < critical_low) | (value > critical_high), "CRITICAL")
            .when((value < low) | (value > high), "ABNORMAL"))


def vitals_alerts(vitals: DataFrame, ranges: dict | None = None) -> DataFrame:
    """One row per reading outside its normal range.

    A message its monitor marked anomalous although every reading is normal yields one row,
    ``device_flag``. The thresholds are part of the expression, so nothing is joined or shuffled.
    """
    severities = {v: _severity(v, limits) for v, limits in (ranges or K.VITAL_RANGES).items()}
    all_normal = F.coalesce(*severities.values()).isNull()
    candidates = [
        F.struct(F.lit(vital).alias("vital"), F.col(vital).cast("double").alias("reading"),
                 severity.alias("severity")) for vital, severity in severities.items()]
    candidates.append(F.struct(
        F.lit("device_flag").alias("vital"), F.lit(None).cast("double").alias("reading"),
        F.when(F.col("is_anomaly") & all_normal, "ABNORMAL").alias("severity")))
    return (vitals.select("message_id", "patient_id", "department", "event_ts", "is_anomaly",
                          F.inline(F.array(*candidates)))
            .filter(F.col("severity").isNotNull()))


def alert_summary(alerts: DataFrame) -> DataFrame:
    """Alerts per day, department and severity, over landed alerts."""
    return (alerts.groupBy(F.to_date("event_ts").alias("alert_date"), "department", "severity")
            .agg(F.count(F.lit(1)).alias("alerts"),
                 F.count_if("is_anomaly").alias("from_flagged_messages"))
            .orderBy("alert_date", "department", "severity"))


def windowed_alert_summary(alerts: DataFrame, late_by: str = K.ALERTS_LATE_BY) -> DataFrame:
    """``alert_summary`` over a stream: a day's counts, once no alert of it is expected any more.

    Repeated alerts of one message count once. State is one row per alert of the last ``late_by``
    and one per open day, department and severity; what comes later than that is left out, and
    alerts without a time belong to no day.
    """
    seen = (alerts.filter(F.col("event_ts").isNotNull()).withWatermark("event_ts", late_by)
            .dropDuplicatesWithinWatermark(["message_id", "vital"]))
    day = F.window("event_ts", "1 day").alias("day")
    return seen.groupBy(day, "department", "severity").agg(
        F.count(F.lit(1)).alias("alerts"),
        F.count_if("is_anomaly").alias("from_flagged_messages")).select(
        F.to_date("day.start").alias("alert_date"), "department", "severity", "alerts",
        "from_flagged_messages")
