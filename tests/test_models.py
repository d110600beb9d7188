from __future__ import annotations

from datetime import date

from helpers import admissions, executed_plan
from wardflow.operators.admissions import flagged_admissions
from wardflow.plans import models


def facts(spark):
    january = [{"discharge_date": f"2024-01-{10 + d}", "attending_doctor": f"dr{d % 2}",
                "patient_id": f"P{d}"} for d in (0, 1, 2, 9)]
    march = [{"admission_date": "2024-03-05", "discharge_date": "2024-03-06"}]
    bad = [{"age": "-1"}]
    return flagged_admissions(admissions(spark, *january, *march, *bad))


def test_models_declare_what_they_read():
    built = {"silver_admissions"}
    for name in models.MODEL_ORDER:
        assert set(models.model_inputs(name)) <= built
        built.add(name)


def test_mart(spark):
    mart = models.build_models(spark, facts(spark))["mart_dept_monthly_kpis"]
    january, march = [r.asDict() for r in mart.orderBy("month_start").collect()]
    assert january["month_start"] == date(2024, 1, 1) and january["year_month"] == "2024-01"
    assert january["total_admissions"] == 4 and january["unique_patients"] == 4
    assert january["active_doctors"] == 2 and january["median_los_days"] == 1.5
    assert january["avg_los_days"] == 3.0 and january["stddev_los"] == 4.08
    assert january["prev_month_admissions"] is None
    assert january["mom_admissions_change_pct"] is None
    assert march["prev_month_admissions"] == 4 and march["mom_admissions_change_pct"] == -75.0
    assert march["stddev_los"] is None and march["rolling_3mo_avg_los"] == 2.0


def test_avg_los_by_department(spark):
    los = models.build_models(spark, facts(spark), only="avg_los_by_department")
    assert list(los) == ["silver_admissions", "stg_admissions", "avg_los_by_department"]
    first = los["avg_los_by_department"].orderBy("admission_month").first()
    assert first["admission_month"] == date(2024, 1, 1) and first["total_admissions"] == 4


def test_identical_stays_have_zero_spread(spark):
    same = flagged_admissions(admissions(spark, {}, {}, {}))
    mart = models.build_models(spark, same)["mart_dept_monthly_kpis"].first()
    assert mart["stddev_los"] == 0.0 and mart["median_los_days"] == 5.0


def test_mart_neither_expands_rows_nor_buffers_values(spark):
    plan = executed_plan(models.build_models(spark, facts(spark))["mart_dept_monthly_kpis"])
    assert "Expand" not in plan
    # The exact median runs on day counts: its aggregate sits above a plain hash aggregate.
    assert plan.index("percentile(") < plan.index("partial_count(1)")


def test_views(spark):
    built = models.build_models(spark, facts(spark))
    models.register_views(built)
    assert spark.sql("SELECT count(*) FROM stg_admissions").first()[0] == 5
