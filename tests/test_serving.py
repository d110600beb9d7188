from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from wardflow.functions import labels, numeric
from wardflow.plans import audit, serving
from wardflow.sources.warehouse import warehouse_export, warehouse_rejects


@pytest.mark.parametrize("value, text", [
    (12_345_678.0, "$12.3M"), (12_000_000.0, "$12M"), (1_500.0, "$1.5K"), (999.04, "$999"),
    (-2_500_000.0, "$-2.5M"), (None, "–")])
def test_magnitude_label(spark, value, text):
    df = spark.createDataFrame([(value,)], "v double")
    assert rows(df.select(labels.magnitude_label(F.col("v"), "$"))) == [(text,)]


def test_numbers_json_cannot_hold_become_null(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (float("inf"),), (None,)], "v double")
    assert [r[0] for r in df.select(numeric.finite_or_null("v")).collect()] == [1.5, None, None, None]


def test_rounding_is_half_up_on_the_decimal_value(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,)], "v double")
    assert [r[0] for r in df.select(numeric.rounded(F.col("v"), 2)).collect()] == [
        1.01, 2.68, -1.01]


def test_cost_tiers_in_their_own_order(spark):
    df = spark.createDataFrame(
        [("VERY_HIGH", 1, 1.0), ("LOW", 1, 1.0), ("odd", 1, 1.0), ("HIGH", 1, 1.0)],
        "cost_tier string, admissions bigint, total_revenue_usd double")
    assert [r[0] for r in serving.cost_tier_mix(df).collect()] == ["LOW", "HIGH", "VERY_HIGH", "odd"]


CRITICAL = ("lab_id string, patient_id string, department string, attending_doctor string, "
            "test_name string, marker string, result_value double, unit string, "
            "reference_low double, reference_high double, result_interpretation string, "
            "deviation_from_range double, lab_status string, tat_minutes double, "
            "collected_at timestamp")


def critical(spark):
    def row(i, dept, doctor, test, status, found="HIGH", tat=10.0):
        return (f"L{i}", "P", dept, doctor, test, "M", 1.0, "u", 0.0, 2.0, found, 0.0, status, tat,
                None)
    return spark.createDataFrame([
        row(1, "ICU", "D1", "CBC", "FINAL"), row(2, "CARDIOLOGY", "D1", "BMP", "FINAL", "LOW"),
        row(3, "ICU", "D1", "BMP", "PRELIMINARY", tat=21.0), row(4, "ICU", "D2", "CBC", "FINAL"),
        row(5, None, None, "CBC", "FINAL")], CRITICAL)


def test_doctor_alerts(spark):
    got = [tuple(r) for r in serving.doctor_alerts(critical(spark)).collect()]
    assert got == [("D1", 3, "CARDIOLOGY, ICU", 2, 1), ("D2", 1, "ICU", 1, 0)]
    table = rows(serving.doctor_alert_table(critical(spark)))
    assert ("D1", "ICU", 2, 2, 16.0) in table and (None, None, 1, 1, 10.0) in table


def test_filters(spark):
    df = critical(spark)
    assert serving.critical_labs_filtered(df).count() == 5
    assert serving.critical_labs_filtered(df, "All", "All", "All").count() == 5
    assert rows(serving.critical_labs_filtered(df, "ICU", "CBC", "FINAL"), "lab_id") == [
        ("L1",), ("L4",)]
    choices = [tuple(r) for r in serving.filter_choices(df).collect()]
    assert choices == [("department", "CARDIOLOGY"), ("department", "ICU"),
                       ("lab_status", "FINAL"), ("lab_status", "PRELIMINARY"),
                       ("test_name", "BMP"), ("test_name", "CBC")]


def test_top_lists_are_cut_after_ordering(spark):
    assert serving.critical_labs(critical(spark), top=2).count() == 2
    assert [r[0] for r in serving.doctor_alerts(critical(spark), top=1).collect()] == ["D1"]


def test_equal_revenue_goes_to_the_first_name(spark):
    df = spark.createDataFrame([("B", "Y", 5.0), ("A", "X", 5.0)],
                               "department string, insurer_name string, total_revenue_usd double")
    assert rows(serving.top_dept_insurer(df), "dimension", "top_name") == [
        ("department", "A"), ("insurer_name", "X")]


def test_trends_have_every_department_there_is(spark):
    df = spark.createDataFrame([("ICU", "2024-01", 3), ("ICU", "2024-02", 4),
                                ("PEDIATRICS", "2024-02", 2), (None, "2024-02", 1)],
                               "department string, year_month string, total_admissions bigint")
    trends = serving.monthly_trends(df)
    assert trends.columns == ["year_month", "ICU", "PEDIATRICS", "UNKNOWN"]
    assert rows(trends) == [("2024-01", 3, 0, 0), ("2024-02", 4, 2, 1)]


def test_audit_figures(spark):
    log = audit.audit_row(spark, "a", "bronze", "success", 10, 8, 1).unionByName(
        audit.audit_row(spark, "b", "silver", "success", 8, 8, 2, "quarantined=0"))
    assert rows(audit.records_flow(log), "step", "dropped") == [("a", 2), ("b", 0)]
    got = audit.audit_kpis(log).first()
    assert (got["steps"], got["records_in"], got["records_out"]) == (2, 18, 16)
    assert got["last_run"] is not None


def test_warehouse_contract(spark):
    from helpers import admissions
    from wardflow.operators.admissions import flagged_admissions, with_lineage
    silver = with_lineage(flagged_admissions(admissions(
        spark, {"gender": "female", "total_cost_usd": "10.005"},
        {"total_cost_usd": "123456789012.00"}, {"total_cost_usd": "10.005"},
        {"admission_id": "A" + "0" * 20})), "b1")
    export, rejects = warehouse_export(silver), warehouse_rejects(silver)
    assert len(export.columns) == 23
    assert [(r["admission_id"], str(r["total_cost_usd"])) for r in export.collect()] == [
        ("A3", "10.01")]
    assert rows(rejects, "admission_id", "misfit_columns") == [
        ("A" + "0" * 20, "admission_id"), ("A1", "gender"), ("A2", "total_cost_usd")]
