"""Types that a delivery's columns hold."""

from __future__ import annotations

from wardflow import constants as K
from wardflow.operators.profile import changed_types, delivery_profile
from wardflow.plans.batch import BatchRun
from wardflow.sources.lake import Lake

KINDS = {"a": "long", "b": "decimal", "c": "date", "d": "boolean", "e": "string", "f": "timestamp"}
DDL = ", ".join(f"{c} string" for c in KINDS)


def profile(spark, rows):
    return delivery_profile(spark.createDataFrame(rows, DDL), KINDS)


def by_column(df):
    return {r.column_name: r for r in df.collect()}


def test_every_kind_and_what_does_not_fit(spark):
    got = by_column(profile(spark, [
        ("1", "2", "2024-02-29", "TRUE", "x", "2024-01-01 00:00:00"),
        (" -7 ", "2.5", "2024-02-30", "false", None, "2024-01-01 25:00:00"),
        (None, "", None, "", "1", None)]))
    assert [got[c].inferred for c in "abcdef"] == ["long", "decimal", "string", "boolean",
                                                   "string", "string"]
    assert [got[c].fits for c in "abcdef"] == [True, True, False, True, True, False]
    assert (got["a"].rows, got["a"].filled, got["c"].as_date, got["f"].as_timestamp) == (3, 2, 1, 1)


def test_empty_delivery_and_empty_column(spark):
    got = by_column(profile(spark, []))
    assert {(r.rows, r.filled, r.inferred, r.fits) for r in got.values()} == {(0, 0, "none", True)}


def test_a_column_that_changes_its_type_is_named(spark):
    before = profile(spark, [("1", "1", "2024-01-01", "true", "x", None)])
    after = profile(spark, [("1.5", "2", None, "true", "y", "2024-01-01 00:00:00")])
    assert [tuple(r) for r in changed_types(before, after).collect()] == [("a", "long", "decimal")]


def test_declared_kinds_name_every_raw_column():
    for kinds, ddl in ((K.ADMISSIONS_KINDS, K.ADMISSIONS_RAW_DDL), (K.LABS_KINDS, K.LABS_RAW_DDL)):
        assert list(kinds) == [c.split()[0] for c in ddl.split(",")]


def test_one_aggregate_and_one_shuffle(spark):
    plan = profile(spark, [("1", "1", None, None, None, None)])._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_a_run_notes_the_profile_of_its_delivery(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))

    def csv(name, kinds, **values):
        path = tmp_path / name
        path.write_text(",".join(kinds) + "\n" + ",".join(values.get(c, "") for c in kinds) + "\n")
        return str(path)

    runs = []
    for batch, age in (("b1", "42"), ("b2", "4.2")):
        run = BatchRun(spark, lake, batch)
        run.ingest(csv(f"a{batch}.csv", K.ADMISSIONS_KINDS, admission_id="1", department="x",
                       age=age),
                   csv(f"l{batch}.csv", K.LABS_KINDS, lab_id="1", test_name="t"))
        runs.append(run)
    before, after = (r.profile(K.ADMISSIONS_SOURCE) for r in runs)
    assert after.count() == len(K.ADMISSIONS_KINDS)
    assert [r.column_name for r in after.filter("not fits").collect()] == ["age"]
    assert [tuple(r) for r in changed_types(before, after).collect()] == [("age", "long", "decimal")]
    assert runs[1].profile(K.LABS_SOURCE).count() == len(K.LABS_KINDS)
