from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from helpers import executed_plan
from wardflow.operators import patient_dim as dim

DDL = ("patient_id string, admission_id int, admission_date date, age int, gender string, "
       "insurance_id string, insurer_name string")
OPEN = date(9999, 12, 31)


def facts(spark, *observed):
    """(patient, admission, day of January 2024, insurer)"""
    return spark.createDataFrame(
        [(p, a, date(2024, 1, 1) + timedelta(days=d - 1), 40, "F", f"ID-{i}", i)
         for p, a, d, i in observed], DDL)


def january(day):
    return date(2024, 1, 1) + timedelta(days=day - 1)


VERSION = ["patient_id", "insurer_name", "valid_from", "valid_to", "is_current"]


def brute_force_history(observed):
    """Versions by walking each patient's days in order."""
    last_of_day = {}
    for p, a, d, i in sorted(observed, key=lambda o: o[1]):
        last_of_day[(p, d)] = i
    versions = []
    for (p, d), i in sorted(last_of_day.items()):
        if versions and versions[-1][0] == p:
            if versions[-1][1] == i:
                continue
            versions[-1][3:] = [january(d) - timedelta(days=1), False]
        versions.append([p, i, january(d), OPEN, True])
    return sorted(map(tuple, versions), key=lambda t: tuple(str(v) for v in t))


def random_facts(seed, n=120, patients=6, days=25):
    rng = random.Random(seed)
    return [(f"P{rng.randrange(patients)}", a, rng.randrange(1, days), rng.choice("ABC"))
            for a in range(n)]


def test_snapshot_takes_the_last_known_value(spark):
    df = spark.createDataFrame(
        [("P1", 1, january(1), 40, "F", "X", "A"), ("P1", 3, january(5), None, None, "Y", "B"),
         ("P1", 2, january(5), 41, None, "Z", "C")], DDL)
    got = dim.patient_snapshot(df).first().asDict()
    assert got == {"patient_id": "P1", "age": 41, "gender": "F", "insurance_id": "Y",
                   "insurer_name": "B", "total_admissions": 3, "last_admission_date": january(5)}


def test_history_there_and_back_again(spark):
    got = rows(dim.scd2_history(facts(
        spark, ("P1", 1, 1, "A"), ("P1", 2, 3, "A"), ("P1", 3, 5, "B"), ("P1", 4, 9, "A"))),
        *VERSION, "total_admissions", "last_admission_date")
    assert got == sorted([
        ("P1", "A", january(1), january(4), False, 2, january(3)),
        ("P1", "B", january(5), january(8), False, 3, january(5)),
        ("P1", "A", january(9), OPEN, True, 4, january(9))],
        key=lambda t: tuple((v is None, str(v)) for v in t))


def test_same_day_conflict_goes_to_the_highest_fact(spark):
    got = rows(dim.scd2_history(facts(
        spark, ("P1", 2, 1, "B"), ("P1", 1, 1, "A"), ("P1", 3, 1, "C"))), *VERSION)
    assert got == [("P1", "C", january(1), OPEN, True)]


@pytest.mark.parametrize("seed", range(3))
def test_history_equals_brute_force(spark, seed):
    observed = random_facts(seed)
    got = rows(dim.scd2_history(facts(spark, *observed), ["insurer_name"]), *VERSION)
    assert sorted(got, key=lambda t: tuple(str(v) for v in t)) == brute_force_history(observed)


def test_merge_expires_and_inserts_in_one_run(spark):
    first = dim.scd2_initial(dim.patient_snapshot(facts(
        spark, ("P1", 1, 1, "A"), ("P2", 2, 1, "A"), ("P3", 3, 1, "A"))))
    second = dim.patient_snapshot(facts(
        spark, ("P1", 4, 10, "B"), ("P2", 5, 10, "A"), ("P4", 6, 10, "C")))
    merged = dim.scd2_merge(first, second)
    assert rows(merged, *VERSION) == sorted([
        ("P1", "A", january(1), january(9), False), ("P1", "B", january(10), OPEN, True),
        ("P2", "A", january(1), OPEN, True), ("P3", "A", january(1), OPEN, True),
        ("P4", "C", january(10), OPEN, True)], key=lambda t: tuple((v is None, str(v)) for v in t))
    again = dim.scd2_merge(merged, second)
    assert rows(again) == rows(merged)
    assert rows(dim.scd2_counts(merged)) == [(5, 4, 1)]


def test_merge_sees_changes_from_and_to_null(spark):
    old = dim.scd2_initial(dim.patient_snapshot(facts(spark, ("P1", 1, 1, "A"), ("P2", 2, 1, None))))
    new = dim.patient_snapshot(facts(spark, ("P1", 3, 5, None), ("P2", 4, 5, "B")))
    assert dim.scd2_merge(old, new).filter("NOT is_current").count() == 2


def test_change_on_the_first_day_replaces_the_version(spark):
    old = dim.scd2_initial(dim.patient_snapshot(facts(spark, ("P1", 1, 5, "A"))))
    new = dim.patient_snapshot(facts(spark, ("P1", 1, 5, "A"), ("P1", 2, 5, "B")))
    assert rows(dim.scd2_merge(old, new), *VERSION) == [("P1", "B", january(5), OPEN, True)]


def test_daily_merges_equal_one_history(spark):
    observed = random_facts(7, n=40, patients=4, days=9)
    current = None
    for day in range(1, 9):
        so_far = [o for o in observed if o[2] <= day]
        if not any(o[2] == day for o in observed):
            continue
        snapshot = dim.patient_snapshot(facts(spark, *so_far))
        merged = (dim.scd2_initial(snapshot) if current is None
                  else dim.scd2_merge(current, snapshot, ["insurer_name"]))
        current = spark.createDataFrame(merged.collect(), merged.schema)
    history = dim.scd2_history(facts(spark, *observed), ["insurer_name"])
    assert rows(current, *VERSION) == rows(history, *VERSION)


def test_late_facts_rebuild_their_patients_only(spark):
    early = [("P1", 1, 10, "A"), ("P2", 2, 10, "A")]
    late = [("P1", 3, 4, "B"), ("P2", 4, 12, "A")]
    old = dim.scd2_history(facts(spark, *early), ["insurer_name"])
    patients = dim.late_patients(old, facts(spark, *late))
    assert rows(patients) == [("P1",)]
    rebuilt = dim.rebuild_patients(old, facts(spark, *early, *late), patients, ["insurer_name"])
    assert rows(rebuilt, *VERSION) == sorted([
        ("P1", "A", january(10), OPEN, True), ("P1", "B", january(4), january(9), False),
        ("P2", "A", january(10), OPEN, True)], key=lambda t: tuple((v is None, str(v)) for v in t))


def test_versions_never_overlap_and_one_is_open(spark):
    versions = dim.scd2_history(facts(spark, *random_facts(11)), ["insurer_name"])
    a, b = versions.alias("a"), versions.alias("b")
    overlapping = a.join(b, "patient_id").filter(
        (F.col("a.valid_from") != F.col("b.valid_from"))
        & (F.col("a.valid_from") <= F.col("b.valid_to"))
        & (F.col("b.valid_from") <= F.col("a.valid_to")))
    assert overlapping.count() == 0
    assert versions.filter("valid_to < valid_from").count() == 0
    open_ones = versions.filter("is_current").groupBy("patient_id").count()
    assert open_ones.filter("count != 1").count() == 0


def test_asof_equals_range_join(spark):
    observed = random_facts(3, n=200)
    known = dim.scd2_history(facts(spark, *observed[:80]), ["insurer_name"]).filter(
        "patient_id != 'P0'")
    asked = facts(spark, *observed).select("patient_id", "admission_id", "admission_date")
    got = dim.asof_lookup(asked, known, ["insurer_name"])
    expected = asked.alias("f").join(
        known.alias("d"), (F.col("f.patient_id") == F.col("d.patient_id"))
        & F.col("f.admission_date").between(F.col("d.valid_from"), F.col("d.valid_to")),
        "left").select("f.*", "d.insurer_name")
    order = ["patient_id", "admission_id", "admission_date", "insurer_name"]
    assert rows(got, *order) == rows(expected, *order)
    assert got.count() == 200
    assert got.filter("insurer_name IS NULL").count() > 0


def test_asof_keeps_undated_facts_and_respects_gaps(spark):
    known = spark.createDataFrame(
        [("P1", "A", january(1), january(3)), ("P1", "B", january(10), OPEN)],
        "patient_id string, insurer_name string, valid_from date, valid_to date")
    asked = spark.createDataFrame(
        [("P1", 1, None), ("P1", 2, january(2)), ("P1", 3, january(5)), ("P1", 4, january(20)),
         (None, 5, january(2))], "patient_id string, admission_id int, admission_date date")
    got = rows(dim.asof_lookup(asked, known, ["insurer_name"]), "admission_id", "insurer_name")
    assert got == [(1, None), (2, "A"), (3, None), (4, "B"), (5, None)]


def test_hot_patient_is_reduced_to_days_before_any_patient_exchange(spark):
    """A third of 30,000 facts belong to one patient, over 20 days."""
    crowd = spark.range(30_000).selectExpr(
        "IF(id % 3 = 0, 'HOT', CONCAT('P', id)) AS patient_id", "CAST(id AS INT) AS admission_id",
        "date_add(DATE '2024-01-01', CAST(id DIV 3 % 20 AS INT)) AS admission_date",
        "40 AS age", "'F' AS gender", "'X' AS insurance_id",
        "IF(id DIV 3 % 2 = 0, 'A', 'B') AS insurer_name")
    history = dim.scd2_history(crowd, ["insurer_name"])
    assert history.filter("patient_id = 'HOT'").count() == 20
    plan = executed_plan(history)
    by_patient = plan.index("Exchange hashpartitioning(patient_id")
    below = plan[by_patient + 10:]
    assert "partial_max_by" in below and "admission_date" in below[below.index("Exchange"):]
    looked_up = dim.asof_lookup(crowd.select("patient_id", "admission_id", "admission_date"),
                                history, ["insurer_name"])
    assert looked_up.count() == 30_000
    assert "NestedLoop" not in executed_plan(looked_up)
    assert "Cartesian" not in executed_plan(looked_up)


@pytest.mark.parametrize("seed", [3, 8, 21])
def test_folded_loads_equal_one_history(spark, seed):
    """Several changes per load, late and equally dated facts, new patients: any split will do."""
    every = facts(spark, *random_facts(seed)).withColumn(
        "load", F.pmod(F.xxhash64("admission_id", F.lit(seed)), F.lit(3)))
    attributes = ["insurer_name"]
    so_far = every.filter("load = 0")
    current = dim.scd2_history(so_far, attributes, attributes)
    for load in (1, 2):
        new = every.filter(F.col("load") == load)
        so_far = so_far.unionByName(new)
        current = dim.scd2_load(current, new, so_far, attributes, attributes)
    want = dim.scd2_history(every, attributes, attributes)
    assert rows(current.select(*want.columns)) == rows(want)
