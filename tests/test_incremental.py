"""Silver merged delivery by delivery against Silver rebuilt from everything."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from helpers import ADMISSION, LAB, admissions, executed_plan
from test_batch import write
from wardflow import constants as K
from wardflow.operators import admissions as adm
from wardflow.operators import dedup, gold, incremental, monthly_state, patient_dim
from wardflow.plans import batch
from wardflow.sources.keyed import KeyedTable
from wardflow.sources.lake import Lake

KEEP = [c for c in K.SILVER_ADMISSIONS_DDL.replace("\n", " ").split(",")]
DDL = ", ".join(c for c in KEEP if "_silver" not in c) + ", _batch_id string"


def delivery(spark, number, *changes):
    raw = admissions(spark, *changes).withColumns({
        "_ingested_at": F.lit(f"2024-01-{number:02} 00:00:00").cast("timestamp"),
        "_batch_id": F.lit(str(number))})
    flagged = adm.flagged_admissions(raw, ["_ingested_at", "_batch_id"], keep=("_batch_id",))
    return flagged.withColumn("outcome", F.when(F.col("dq_flag") == K.VALID, "valid")
                              .otherwise("rejected"))


def keyed(spark, path):
    return KeyedTable(spark, str(path), DDL, ["admission_id"],
                      ["outcome", "department", "admission_year"], buckets=4)


DELIVERIES = [
    [{"admission_id": f"A{i}", "department": ["ICU", "Cardiology", None][i % 3],
      "admission_date": f"20{20 + i % 4}-01-10", "discharge_date": f"20{20 + i % 4}-01-12"}
     for i in range(24)] + [{"admission_id": None}, {"admission_id": None, "age": "-5"}],
    # corrected into another folder, rejected, un-rejected, new, without a key
    [{"admission_id": "A1", "department": "Oncology"}, {"admission_id": "A3", "age": "-1"},
     {"admission_id": "A2", "department": "ICU"}, {"admission_id": "N1"},
     {"admission_id": None, "department": "Neurology"}],
]


def test_two_deliveries_equal_one_rebuild(spark, tmp_path):
    table = keyed(spark, tmp_path / "silver")
    parts = [delivery(spark, n + 1, *changes) for n, changes in enumerate(DELIVERIES)]
    seen = [table.merge(part) for part in parts]
    whole = dedup.latest_per_key(parts[0].unionByName(parts[1]), ["admission_id"],
                                 ["_ingested_at", "_batch_id"])
    got = table.read()
    assert rows(got.select(*sorted(got.columns))) == rows(whole.select(*sorted(got.columns)))
    assert seen[0]["read"] == 0 and 0 < seen[1]["read"] < 26
    again = table.merge(parts[1])
    assert again["read"] == again["rows"]
    assert rows(table.read().select(*sorted(got.columns))) == rows(
        whole.select(*sorted(got.columns)))


def test_late_older_versions_do_not_win(spark, tmp_path):
    table = keyed(spark, tmp_path / "silver")
    table.merge(delivery(spark, 9, {"admission_id": "A1", "num_procedures": "9"}))
    table.merge(delivery(spark, 3, {"admission_id": "A1", "num_procedures": "3",
                                    "department": "ICU"}))
    assert rows(table.read(), "num_procedures", "department") == [(9, "CARDIOLOGY")]


def test_other_partitions_keep_their_files_and_empty_ones_go(spark, tmp_path):
    table = keyed(spark, tmp_path / "silver")
    table.merge(delivery(spark, 1, {"admission_id": "A1", "department": "ICU"},
                         {"admission_id": "A2", "department": "Oncology"},
                         {"admission_id": "A3", "department": "Neurology"}))

    def files():
        return {str(p) for p in (tmp_path / "silver").rglob("*.parquet")}
    before = files()
    table.merge(delivery(spark, 2, {"admission_id": "A1", "department": "Neurology"}))
    after = files()
    assert {f for f in before & after} == {f for f in before if "ONCOLOGY" in f}
    assert not any("ICU" in f for f in after)
    assert not Path(f"{tmp_path}/silver_delivered").exists() or not list(
        Path(f"{tmp_path}/silver_delivered").iterdir())


def test_a_delivery_joins_without_moving_the_table(spark, tmp_path):
    table = keyed(spark, tmp_path / "silver")
    table.merge(delivery(spark, 1, *DELIVERIES[0]))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        named = delivery(spark, 2, *DELIVERIES[1]).select("admission_id", "_batch_id")
        kept = incremental._with_keys(table.read(), named.select("admission_id"),
                                      ["admission_id"], "left_semi")
        plan = executed_plan(kept)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    table_side = plan[plan.index("SortMergeJoin"):plan.index("FileScan")]
    assert "Exchange" not in table_side and "Bucketed: true" in plan


@pytest.fixture(scope="module")
def two_csv_deliveries(tmp_path_factory):
    folder = tmp_path_factory.mktemp("deliveries")
    departments = ["Cardiology", "ICU", "Oncology"]

    def visit(i, **change):
        return {"admission_id": f"A{i:03}", "patient_id": f"P{i % 9}",
                "admission_date": f"2024-{1 + i % 6:02}-0{1 + i % 9}",
                "discharge_date": f"2024-{1 + i % 6:02}-1{i % 9}",
                "department": departments[i % 3], "insurer_name": ["Aetna", "Cigna"][i % 2],
                "age": str(20 + i % 60), "readmission": str(i % 5 == 0).lower(), **change}

    def result(i, **change):
        return {"lab_id": f"L{i:03}", "admission_id": f"A{i % 40:03}", "result_value": str(i % 20),
                "is_critical": str(i % 4 == 0).lower(), **change}
    first = ([visit(i) for i in range(40)], [result(i) for i in range(30)])
    # New facts, corrected ones (another patient, department, month), one without a patient.
    second = ([visit(i, admission_date=f"2024-08-0{1 + i % 9}", discharge_date="2024-08-20")
               for i in range(40, 52)]
              + [visit(3, patient_id="P8"), visit(7, department="ICU"), visit(9, age="-3"),
                 visit(11, insurer_name="Humana"), visit(60, patient_id=""),
                 visit(61, department="")],
              [result(i, result_value="77") for i in range(25, 36)])
    return [(write(folder / f"a{n}.csv", ADMISSION, a), write(folder / f"l{n}.csv", LAB, b))
            for n, (a, b) in enumerate((first, second))]


def test_incremental_runs_equal_rebuilds(spark, tmp_path, two_csv_deliveries):
    """Silver, the dimension and every Gold table, run by run; a bad row stops no publish."""
    lakes = {mode: Lake(spark, str(tmp_path / str(mode))) for mode in (False, True)}
    for n, files in enumerate(two_csv_deliveries):
        for mode, lake in lakes.items():
            run = batch.run_batch(spark, lake, f"2024010{n + 1}_020000", *files, min_group=2,
                                  as_of=F.lit("2024-12-31").cast("timestamp"), incremental=mode)
    steps = {s["step"]: s for s in run.steps}
    assert steps["transform_admissions"]["notes"].startswith("partitions=")
    full, merged = lakes[False], lakes[True]

    def content(df):
        return rows(df.select(*sorted(c for c in df.columns if not c.startswith("_"))))
    for table in batch.CURRENT:
        assert content(batch.silver(merged, table)) == content(batch.silver(full, table))
        assert content(batch.quarantine(merged, table)) == content(batch.quarantine(full, table))
    flags = {r.dq_flag for r in batch.quarantine(merged, batch.SILVER_ADMISSIONS).collect()}
    assert flags == {K.AGE_NEGATIVE, K.PATIENT_ID_MISSING, K.DEPARTMENT_MISSING}
    for table in batch.TABLES:
        if table not in batch.CURRENT and table != batch.EXPECTATIONS:
            got, want = merged.read(table), full.read(table)
            assert content(got.select(*want.columns)) == content(want), table
    numbers = merged.read(batch.NUMBERS)
    assert numbers.count() == numbers.agg(F.max("number") + 1).first()[0] == 9


def test_rebuilding_a_merged_lake_is_refused(spark, tmp_path, two_csv_deliveries):
    lake = Lake(spark, str(tmp_path))
    batch.run_batch(spark, lake, "1", *two_csv_deliveries[0], incremental=True,
                    stages=["ingest", "build_silver"])
    with pytest.raises(ValueError, match="incrementally"):
        batch.run_batch(spark, lake, "2", *two_csv_deliveries[1], stages=["build_silver"])


def facts_of(spark, *items):
    return spark.createDataFrame(
        [(p, a, d, 40, "F", i, i) for p, a, d, i in items],
        "patient_id string, admission_id long, admission_date string, age int, gender string, "
        "insurance_id string, insurer_name string").withColumn(
        "admission_date", F.col("admission_date").cast("date"))


def test_facts_without_a_patient_are_not_lost(spark):
    items = [(None, 1, "2024-01-01", "X"), (None, 2, "2024-02-01", "X"), ("P", 3, "2024-01-05", "X"),
             (None, 4, "2024-03-01", "Y"), ("P", 5, "2024-01-02", "Y"), ("Q", 6, "2024-01-02", "Y")]
    every = facts_of(spark, *items)
    want = rows(patient_dim.scd2_history(every))
    for split in range(1, len(items)):
        dim = patient_dim.scd2_history(facts_of(spark, *items[:split]))
        got = patient_dim.scd2_load(dim, facts_of(spark, *items[split:]), every)
        assert rows(got) == want
        rebuilt = patient_dim.rebuild_patients(
            dim, every, facts_of(spark, *items[split:]).select("patient_id").distinct())
        assert rows(rebuilt) == want


def test_corrected_patients_are_rebuilt(spark):
    old = facts_of(spark, ("P", 1, "2024-01-01", "X"), ("Q", 2, "2024-01-01", "X"))
    now = facts_of(spark, ("Q", 1, "2024-01-01", "Z"), ("Q", 2, "2024-01-01", "X"),
                   ("Q", 3, "2024-05-01", "Y"))
    patients = spark.createDataFrame([("P",), ("Q",), ("Q",)], "patient_id string")
    got = patient_dim.scd2_load(patient_dim.scd2_history(old), now.filter("admission_id = 3"), now,
                                corrected=patients)
    assert rows(got) == rows(patient_dim.scd2_history(now))


def test_monthly_states_merge(spark):
    raw = admissions(spark, *[
        {"patient_id": f"P{i % 7}" if i % 9 else None, "department": ["ICU", "Oncology"][i % 2],
         "admission_date": f"2024-0{1 + i % 3}-01", "discharge_date": f"2024-0{1 + i % 3}-1{i % 7}",
         "readmission": str(i % 4 == 0).lower(), "age": str(i) if i % 5 else None}
        for i in range(60)])
    facts = adm.flagged_admissions(raw)
    numbers = monthly_state.number_patients(facts, slices=3)
    assert sorted(r.number for r in numbers.collect()) == list(range(7))
    parts = [monthly_state.monthly_state(facts.filter(f"admission_id {op} 'A3'"), numbers)
             for op in ("<", ">=")]
    whole = monthly_state.merged(*parts)
    want = rows(gold.dept_monthly_kpis(facts))
    columns = gold.dept_monthly_kpis(facts).columns
    assert rows(monthly_state.kpis_from_state(whole), *columns) == want
    months = spark.createDataFrame([("ICU", "2024-02-01")], "department string, month string") \
        .withColumn("month", F.col("month").cast("date"))
    broken = monthly_state.MonthlyState(
        whole.sums.withColumn("n", F.when(F.col("department") == "ICU", F.col("n") * 2)
                              .otherwise(F.col("n"))), whole.patients)
    fresh = monthly_state.monthly_state(
        facts.filter("department = 'ICU' AND admission_month = 2"), numbers)
    mended = monthly_state.kpis_from_state(monthly_state.replaced_months(broken, months, fresh))
    assert [r[:16] for r in rows(mended, *columns) if r[1] == "2024-02"] == [
        r[:16] for r in want if r[1] == "2024-02"]  # rolling means still see the broken months


def test_known_patients_keep_their_numbers(spark):
    def people(*names):
        return spark.createDataFrame([(n,) for n in names], "patient_id string")
    first = monthly_state.number_patients(people("a", "b", None, "b"), slices=2)
    second = monthly_state.number_patients(people("c", "a", "d"), first, slices=2)
    known, now = dict(rows(first)), dict(rows(second))
    assert {k: now[k] for k in known} == known and sorted(now.values()) == [0, 1, 2, 3]
