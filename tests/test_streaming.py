from __future__ import annotations

import json

import pytest
from datetime import datetime

from conftest import rows
from wardflow import constants as K
from wardflow.streaming import jobs, vitals

NORMAL = {"message_id": "m1", "patient_id": "P1", "department": "ICU",
          "timestamp": "2024-01-01T10:00:00.250000Z", "patient_state": "stable",
          "is_anomaly": False, "heart_rate": 70, "systolic_bp": 120, "diastolic_bp": 75,
          "spo2_pct": 98, "temperature_c": 37.0, "resp_rate": 15}


def messages(spark, *payloads):
    texts = [p if p is None or isinstance(p, str) else json.dumps(p) for p in payloads]
    return spark.createDataFrame(
        [(t.encode() if t is not None else None,) for t in texts], "value binary")


def reading(**change):
    return {**NORMAL, **change}


def test_parse(spark):
    got = vitals.parse_vitals(messages(spark, NORMAL)).first().asDict()
    assert got["event_ts"] == datetime(2024, 1, 1, 10, 0, 0, 250000)
    assert got["spo2_pct"] == 98 and got["resp_rate"] == 15 and got["temperature_c"] == 37.0
    assert got["timestamp"] == NORMAL["timestamp"] and "_corrupt" not in got


def test_every_message_is_parsed_or_a_dead_letter(spark):
    broken = ["{bad", "", "[]", '{"patient_id": "P1"}', json.dumps(reading(heart_rate="fast")),
              '"text"', None]
    source = messages(spark, NORMAL, *broken)
    assert rows(vitals.parse_vitals(source), "message_id") == [("m1",)]
    letters = rows(vitals.dead_letters(source))
    assert len(letters) == len(broken)
    assert ("{bad",) in letters and (None,) in letters


@pytest.mark.parametrize("text", ["noon", "12:30", "2024-01-01", "2024-13-01T00:00:00Z", ""])
def test_a_time_that_is_none_makes_a_dead_letter(spark, text):
    source = messages(spark, reading(timestamp=text))
    assert vitals.parse_vitals(source).count() == 0
    assert text in vitals.dead_letters(source).first()["raw_value"]


def test_full_times_in_their_forms(spark):
    times = ["2024-01-01T10:00:00Z", "2024-01-01 10:00:00", "2024-01-01T10:00:00.5+01:00", None]
    got = vitals.parse_vitals(messages(spark, *[
        reading(message_id=str(i), timestamp=t) for i, t in enumerate(times)]))
    assert [r["event_ts"] and r["event_ts"].hour for r in got.orderBy("message_id").collect()] \
        == [10, 10, 9, None]


def alerts(spark, **change):
    parsed = vitals.parse_vitals(messages(spark, reading(**change)))
    return rows(vitals.vitals_alerts(parsed), "vital", "reading", "severity")


def test_alert_levels_are_strict(spark):
    assert alerts(spark) == []
    assert alerts(spark, heart_rate=100) == [] and alerts(spark, heart_rate=55) == []
    assert alerts(spark, heart_rate=101) == [("heart_rate", 101.0, "ABNORMAL")]
    assert alerts(spark, heart_rate=180) == [("heart_rate", 180.0, "ABNORMAL")]
    assert alerts(spark, heart_rate=181) == [("heart_rate", 181.0, "CRITICAL")]
    assert alerts(spark, spo2_pct=84, temperature_c=40.6) == [
        ("spo2_pct", 84.0, "CRITICAL"), ("temperature_c", 40.6, "CRITICAL")]
    assert alerts(spark, heart_rate=None) == []


def test_flagged_message_with_normal_readings_still_alerts(spark):
    assert alerts(spark, is_anomaly=True) == [("device_flag", None, "ABNORMAL")]
    assert alerts(spark, is_anomaly=True, resp_rate=3) == [("resp_rate", 3.0, "CRITICAL")]


def test_thresholds_can_be_replaced(spark):
    parsed = vitals.parse_vitals(messages(spark, reading(heart_rate=90)))
    strict = {"heart_rate": (60, 80, 40, 85)}
    assert rows(vitals.vitals_alerts(parsed, strict), "severity") == [("CRITICAL",)]


def test_summary(spark):
    parsed = vitals.parse_vitals(messages(
        spark, reading(heart_rate=200), reading(message_id="m2", heart_rate=110, is_anomaly=True),
        reading(message_id="m3", spo2_pct=50)))
    got = rows(vitals.alert_summary(vitals.vitals_alerts(parsed)),
               "department", "severity", "alerts", "from_flagged_messages")
    assert got == [("ICU", "ABNORMAL", 1, 1), ("ICU", "CRITICAL", 2, 0)]


def test_stream_equals_batch_and_restarts_add_nothing(spark, tmp_path):
    inbox, root, checkpoints = tmp_path / "in", str(tmp_path / "lake"), str(tmp_path / "chk")
    inbox.mkdir()

    def deliver(name, *payloads):
        lines = [p if isinstance(p, str) else json.dumps(p) for p in payloads]
        (inbox / name).write_text("\n".join(lines) + "\n")

    def run():
        queries = jobs.start_vitals(jobs.file_messages(spark, str(inbox)), root, checkpoints,
                                    available_now=True)
        for query in queries.values():
            query.awaitTermination()
        return {name: spark.read.parquet(f"{root}/{name}") for name in queries}

    deliver("a.json", reading(heart_rate=200), "{bad", reading(message_id="m2"))
    landed = run()
    batch = messages(spark, reading(heart_rate=200), "{bad", reading(message_id="m2"))
    parsed = vitals.parse_vitals(batch)
    assert rows(landed["vitals"].drop("_ingested_at")) == rows(parsed)
    assert rows(landed["vitals_alerts"].drop("_ingested_at")) == rows(vitals.vitals_alerts(parsed))
    assert rows(landed["vitals_dead_letters"], "raw_value") == [("{bad",)]

    assert {n: t.count() for n, t in run().items()} == {
        "vitals_raw": 3, "vitals": 2, "vitals_dead_letters": 1, "vitals_alerts": 1}
    deliver("b.json", reading(message_id="m3", heart_rate=200))
    after = run()
    assert after["vitals"].count() == 3 and after["vitals_raw"].count() == 4
    alerted = after["vitals_alerts"].select("message_id")
    assert alerted.count() == 2
    assert alerted.join(after["vitals"], "message_id", "left_anti").count() == 0

    # An alert job of its own over the landed table finds the same alerts.
    landed_stream = jobs.landed_vitals(spark, f"{root}/vitals")
    apart = jobs.append_stream(vitals.vitals_alerts(landed_stream), str(tmp_path / "apart"),
                               f"{checkpoints}/apart", available_now=True)
    apart.awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "apart"))) == rows(
        after["vitals_alerts"].drop("_ingested_at"))


def test_message_schema_names_every_vital():
    for vital in K.VITAL_RANGES:
        assert f"{vital} " in K.VITALS_MESSAGE_DDL
