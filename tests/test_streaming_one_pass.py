"""Readings, dead letters and alerts of a micro-batch in one pass, and the summary as a stream."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import StreamingQueryException

from conftest import rows
from test_streaming import messages, reading
from wardflow.streaming import jobs, vitals


def deliver(inbox, name, *payloads):
    inbox.mkdir(exist_ok=True)
    lines = [p if isinstance(p, str) else json.dumps(p) for p in payloads]
    (inbox / name).write_text("\n".join(lines) + "\n")


def compare(spark, root, *payloads):
    got, batch = jobs.landed_outputs(spark, root), messages(spark, *payloads)
    parsed = vitals.parse_vitals(batch)
    assert rows(got["vitals"]) == rows(parsed)
    assert rows(got["vitals_dead_letters"]) == rows(vitals.dead_letters(batch))
    assert rows(got["vitals_alerts"].drop("_ingested_at")) == rows(vitals.vitals_alerts(parsed))


def test_a_run_that_dies_after_the_first_write_doubles_and_loses_nothing(
        spark, tmp_path, monkeypatch):
    inbox, root, checkpoints = tmp_path / "in", str(tmp_path / "lake"), str(tmp_path / "chk")
    first = [reading(heart_rate=200), "{bad", reading(message_id="m2")]
    second = [reading(message_id="m3", spo2_pct=50), "", reading(message_id="m4", is_anomaly=True)]

    def run():
        jobs.start_vitals_in_one_pass(jobs.file_messages(spark, str(inbox)), root, checkpoints,
                                      available_now=True).awaitTermination()

    deliver(inbox, "a.json", *first)
    run()
    compare(spark, root, *first)
    deliver(inbox, "b.json", *second)

    def dies(_):
        raise RuntimeError("lost")
    with monkeypatch.context() as broken:
        broken.setattr(jobs.vitals, "vitals_alerts", dies)
        with pytest.raises(StreamingQueryException):
            run()
    run()
    compare(spark, root, *first, *second)
    run()
    compare(spark, root, *first, *second)


def test_a_message_is_parsed_once(spark):
    source = messages(spark, reading())
    plan = vitals.decided(source)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1 and plan.count("try_to_timestamp(") <= 1 \
        and plan.count("gettimestamp(") <= 1


def test_windowed_summary_equals_the_batch_after_late_and_repeated_input(spark, tmp_path):
    inbox, root, checkpoints = tmp_path / "in", str(tmp_path / "lake"), str(tmp_path / "chk")

    def at(message, time, **change):
        return reading(message_id=message, timestamp=f"2024-01-{time}Z", heart_rate=200, **change)

    def run():
        parsed = vitals.parse_vitals(jobs.file_messages(spark, str(inbox)))
        jobs.start_alert_summary(vitals.vitals_alerts(parsed), root, checkpoints,
                                 available_now=True).awaitTermination()

    one = [at("m1", "01T10:00:00"), at("m2", "01T23:30:00", department="ICU", spo2_pct=50)]
    two = [at("m3", "02T00:30:00"), at("m1", "01T10:00:00"), at("m4", "01T23:00:00",
                                                                is_anomaly=True)]
    closing = [at("m9", "05T00:00:00")]
    for name, payloads in (("a", one), ("b", two), ("c", closing)):
        deliver(inbox, f"{name}.json", *payloads)
        run()
    every = vitals.vitals_alerts(vitals.parse_vitals(messages(spark, *one, two[0], two[2])))
    want = vitals.alert_summary(every)
    assert rows(spark.read.parquet(f"{root}/alert_summary"), *want.columns) == rows(want)
