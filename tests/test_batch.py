"""The whole batch over CSV files, reruns included."""

from __future__ import annotations

import csv

import pytest
from pyspark.sql import functions as F

from conftest import rows
from helpers import ADMISSION, LAB
from wardflow import constants as K
from wardflow.operators import patient_dim, quality
from wardflow.plans import batch, endpoints
from wardflow.sources import files
from wardflow.sources.lake import Lake


def write(path, base, changes):
    with open(path, "w", newline="") as out:
        writer = csv.DictWriter(out, list(base))
        writer.writeheader()
        writer.writerows({**base, **c} for c in changes)
    return str(path)


@pytest.fixture(scope="module")
def delivered(tmp_path_factory):
    folder = tmp_path_factory.mktemp("delivery")
    departments = ["Cardiology", " cardiology", "ICU"]
    admissions = [{"admission_id": f"A{i:03}", "patient_id": f"P{i % 7}",
                   "admission_date": f"2024-{1 + i % 12:02}-0{1 + i % 9}",
                   "discharge_date": f"2024-{1 + i % 12:02}-1{i % 9}",
                   "department": departments[i % 3], "insurer_name": ["Aetna", "Cigna", ""][i % 3],
                   "age": "-1" if i == 5 else str(20 + i % 60),
                   "readmission": str(i % 5 == 0).lower()} for i in range(60)]
    admissions.append({**admissions[0], "num_procedures": "9"})
    labs = [{"lab_id": f"L{i // 2:03}", "marker": f"M{i % 2}", "admission_id": f"A{i % 60:03}",
             "result_value": "" if i == 3 else str(i % 20), "is_critical": str(i % 4 == 0).lower()}
            for i in range(80)]
    return (write(folder / "admissions.csv", ADMISSION, admissions),
            write(folder / "labs.csv", LAB, labs))


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory, delivered):
    lake = Lake(spark, str(tmp_path_factory.mktemp("lake")))
    run = batch.run_batch(spark, lake, "20240101_020000", *delivered, min_group=2,
                          as_of=F.lit("2024-12-31").cast("timestamp"))
    return lake, run


def test_counts_agree_from_step_to_step(finished):
    lake, run = finished
    steps = {s["step"]: s for s in run.steps}
    assert steps["ingest_admissions"]["records_out"] == 61
    assert steps["transform_admissions"]["records_out"] == 59
    assert steps["transform_admissions"]["notes"] == "quarantined=1"
    assert steps["transform_labs"]["records_out"] == 79
    assert steps["build_critical_labs_watch"]["records_out"] == 20
    assert lake.read(batch.GOLD_KPIS).count() == steps["build_dept_kpis"]["records_out"]
    logged = lake.read_batches(batch.AUDIT, f"{K.AUDIT_DDL}, _batch_id string")
    assert logged.count() == len(run.steps) == 11


def test_silver_and_quarantine(finished):
    lake, run = finished
    facts = run.silver(batch.SILVER_ADMISSIONS)
    assert facts.count() == 59
    assert rows(facts.select("department").distinct()) == [("CARDIOLOGY",), ("ICU",)]
    rejected = rows(run.quarantine(batch.SILVER_ADMISSIONS), "admission_id", "dq_flag")
    assert rejected == [("A005", K.AGE_NEGATIVE)]
    assert rows(run.quarantine(batch.SILVER_LABS), "dq_flag") == [(K.RESULT_MISSING,)]
    assert dict(facts.dtypes)["total_cost_usd"] == "decimal(18,4)"
    assert dict(facts.dtypes)["admission_year"] == "int"


def test_folders_prune(finished):
    _, run = finished
    facts = run.silver(batch.SILVER_ADMISSIONS).filter("department = 'ICU'").select("age")
    plan = facts._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan[plan.index("PartitionFilters"):]
    assert "outcome" in partition_filters and "department" in partition_filters
    assert "ReadSchema: struct<age:int>" in plan


def test_dimension(finished):
    _, run = finished
    dim = run.patient_dim()
    assert dim.filter("is_current").count() == 7
    facts = run.silver(batch.SILVER_ADMISSIONS)
    looked_up = patient_dim.asof_lookup(
        facts.select("admission_id", "patient_id", "admission_date"), dim, ["insurer_name"])
    assert looked_up.filter("insurer_name IS NULL").count() == 0
    assert looked_up.count() == 59


def test_every_endpoint_answers(finished):
    lake, _ = finished
    got = {name: query(lake).count() for name, query in endpoints.ENDPOINTS.items()}
    assert endpoints.ENDPOINTS["summary"](lake).first()["last_run"] is not None
    spark = lake.spark
    spark.createDataFrame([], "event_ts timestamp, department string, severity string, "
                              "is_anomaly boolean").write.parquet(lake.path("bronze/vitals_alerts"))
    empty = {"bronze-rejects", "alert-summary", "warehouse-rejects"}
    views = {name: query(lake).count() for name, query in endpoints.VIEWS.items()}
    assert {name for name, n in views.items() if n == 0} <= empty | {"high-risk-groups",
                                                                    "critical-departments"}
    assert views["load-history"] == 1 and views["warehouse"] == 59
    assert got.pop("audit") >= 11
    assert got["summary"] == 1 and got["dept-annual"] == 2 and got["critical-labs"] == 20
    assert all(got.values())
    summary = endpoints.ENDPOINTS["summary"](lake).first()
    assert (summary["total_admissions"], summary["quarantined"]) == (59, 1)
    assert summary["data_quality_pct"] == 98.3


def test_expectation_results_are_kept(finished):
    lake, _ = finished
    results = {(r["table_name"], r["column_name"], r["test"]): r["failures"]
               for r in lake.read(batch.EXPECTATIONS).collect()}
    assert results[(batch.SILVER_ADMISSIONS, "admission_id", "unique")] == 0
    assert results[(batch.SILVER_LABS, "lab_id, marker", "unique")] == 0
    assert results[(batch.GOLD_LOS, "department", "accepted_values")] == 0


def test_rerun_of_a_batch_changes_nothing(spark, finished, delivered):
    lake, run = finished
    before = rows(run.silver(batch.SILVER_ADMISSIONS).drop("_ingested_at", "_silver_processed_at"))
    again = batch.run_batch(spark, lake, run.batch_id, *delivered, min_group=2)
    after = rows(again.silver(batch.SILVER_ADMISSIONS).drop("_ingested_at", "_silver_processed_at"))
    assert before == after
    assert run.bronze(batch.BRONZE_ADMISSIONS).count() == 61
    assert again.quarantine(batch.SILVER_ADMISSIONS).count() == 1


def test_second_batch_appends_and_replaces(spark, finished, tmp_path):
    lake, _ = finished
    newer = write(tmp_path / "a.csv", ADMISSION, [
        {"admission_id": "A001", "num_procedures": "8", "department": "ICU"},
        {"admission_id": "NEW", "department": "Oncology"}])
    labs = write(tmp_path / "l.csv", LAB, [{"lab_id": "NEW"}])
    run = batch.run_batch(spark, lake, "20240102_020000", newer, labs)
    assert run.bronze(batch.BRONZE_ADMISSIONS).count() == 63
    facts = run.silver(batch.SILVER_ADMISSIONS)
    assert facts.count() == 60
    assert facts.filter("admission_id = 'A001'").first()["num_procedures"] == 8
    assert rows(run.patient_dim()) == rows(patient_dim.scd2_history(facts).select(
        *run.patient_dim().columns))
    assert len(lake.versions(batch.SILVER_ADMISSIONS)) >= 2
    assert lake.expire(keep=1)
    assert lake.versions(batch.SILVER_ADMISSIONS) == [
        lake.published()[batch.SILVER_ADMISSIONS]]
    assert batch.silver(lake, batch.SILVER_ADMISSIONS).count() == 60


def test_unfinished_version_is_not_read(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.write_version(spark.range(3), "t", "9")
    lake.write_version(spark.range(4), "t", "9")
    lake.write_version(spark.range(5), "t", "10")
    with pytest.raises(FileNotFoundError):
        lake.read("t")
    lake.publish("9", ["t"])
    assert lake.read("t").count() == 4
    lake.publish("10", ["t"])
    assert lake.read("t").count() == 5  # the run published last, whatever its name
    (tmp_path / "t" / "_version=9" / "_attempt=000002" / "_SUCCESS").unlink()
    assert lake.read("t", version="9").count() == 3
    assert lake.expire(keep=1) == ["t/_version=9/_attempt=000002"]
    with pytest.raises(FileNotFoundError):
        lake.read("nothing")


def test_uncommitted_batches_are_not_read(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.write_batch(spark.range(3), "t", "a")
    lake.write_batch(spark.range(5), "t", "b")
    lake.write_batch(spark.range(7), "t", "b")
    ddl = "id bigint, _batch_id string"
    assert lake.read_batches("t", ddl).count() == 10
    (tmp_path / "t" / "_batch_id=b" / "_attempt=000002" / "_SUCCESS").unlink()
    assert lake.read_batches("t", ddl).count() == 8
    (tmp_path / "t" / "_batch_id=b" / "_attempt=000001" / "_SUCCESS").unlink()
    assert rows(lake.read_batches("t", ddl), "_batch_id") == [("a",)] * 3
    assert lake.read_batches("nothing", ddl).count() == 0


def test_shifted_lines_are_rejected_with_their_text(spark, tmp_path):
    path = write(tmp_path / "a.csv", ADMISSION, [{}, {"admission_id": "A2"}])
    text = open(path).read().replace("\nP1,A2,", "\nP1,A2,one too many,")
    open(path, "w").write(text)
    lines = files.read_csv_lines(spark, [path], K.ADMISSIONS_RAW_DDL)
    assert rows(files.well_formed(lines), "admission_id") == [("A1",)]
    assert "one too many" in files.malformed(lines).first()["raw_line"]


def test_a_failed_gate_or_a_crash_leaves_the_old_data_in_place(spark, finished, tmp_path,
                                                               monkeypatch):
    lake, _ = finished
    before = lake.published()
    bad = write(tmp_path / "a.csv", ADMISSION, [{"admission_id": "BAD", "department": "ICU"}])
    labs = write(tmp_path / "l.csv", LAB, [{"lab_id": "BAD"}])
    summary = rows(endpoints.ENDPOINTS["dept-annual"](lake))
    monkeypatch.setattr(batch.gold, "financial_summary", lambda facts: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        batch.run_batch(spark, lake, "crash", bad, labs)
    monkeypatch.undo()
    monkeypatch.setattr(K, "MAX_SANE_RATE_PCT", -1)
    with pytest.raises(quality.QualityError):
        batch.run_batch(spark, lake, "gate", bad, labs)
    assert lake.published() == before
    assert rows(endpoints.ENDPOINTS["dept-annual"](lake)) == summary


def test_failed_gate_stops_the_run(spark, tmp_path):
    bad = write(tmp_path / "a.csv", ADMISSION, [{"age": "-1"}])
    labs = write(tmp_path / "l.csv", LAB, [{}])
    lake = Lake(spark, str(tmp_path / "lake"))
    with pytest.raises(quality.QualityError):
        batch.run_batch(spark, lake, "b", bad, labs)
    last = endpoints.ENDPOINTS["audit"](lake).collect()[-1]
    assert (last["step"], last["status"]) == ("check", "failure")
    assert "admissions_not_empty" in last["notes"]


def test_command_line():
    from wardflow.main import arguments
    args = arguments(["batch", "--lake", "/l", "--admissions", "a", "--labs", "b",
                      "--stage", "build_gold", "--batch-id", "x"])
    assert args.stage == ["build_gold"] and args.batch_id == "x" and args.keep == 2
    assert arguments(["query", "--lake", "/l", "--endpoint", "risk-bubble"]).csv is None
    assert arguments(["query", "--lake", "/l", "--endpoint", "cost-tier"]).endpoint == "cost-tier"
    with pytest.raises(SystemExit):
        arguments(["stream", "--lake", "/l", "--checkpoints", "/c"])


def test_csv_source_reads_text_and_nulls(spark, delivered):
    raw = files.read_admissions_csv(spark, delivered[0])
    assert set(dict(raw.dtypes).values()) == {"string"}
    assert raw.filter("insurer_name IS NULL").count() == 20


def test_csv_and_json_sinks(spark, finished, tmp_path):
    lake, _ = finished
    kpis = lake.read(batch.GOLD_KPIS)
    files.write_csv(kpis, str(tmp_path / "kpis"))
    back = spark.read.option("header", True).csv(str(tmp_path / "kpis"))
    assert back.columns == kpis.columns and back.count() == kpis.count()
    log = lake.read_batches(batch.AUDIT, f"{K.AUDIT_DDL}, _batch_id string").drop("_batch_id")
    files.write_audit_json(log, str(tmp_path / "audit"))
    assert rows(files.read_audit_json(spark, str(tmp_path / "audit"))) == rows(log)
    (tmp_path / "array.json").write_text(
        '[{"step": "x", "records_in": 3}, {"step": "y", "records_in": 4}]')
    array = files.read_audit_json(spark, str(tmp_path / "array.json"), array=True)
    assert rows(array, "step", "records_in") == [("x", 3), ("y", 4)]
