"""Every read-side query by name, over a lake that ``run_batch`` has filled and published."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wardflow import constants as K
from wardflow.operators import ingest, patient_dim, quality, reports
from wardflow.plans import audit, serving
from wardflow.plans.batch import (
    AUDIT, BRONZE_ADMISSIONS, BRONZE_REJECTS, EXPECTATIONS, GOLD_CRITICAL, GOLD_FINANCE, GOLD_KPIS,
    GOLD_READMISSIONS, PATIENT_DIM, REJECTS_DDL, SILVER_ADMISSIONS, SILVER_LABS, BatchRun,
    quarantine, silver,
)
from wardflow.sources.lake import Lake
from wardflow.sources.warehouse import warehouse_export, warehouse_rejects
from wardflow.streaming.vitals import alert_summary


def audit_log(lake: Lake) -> DataFrame:
    return lake.read_batches(AUDIT, f"{K.AUDIT_DDL}, _batch_id string").drop("_batch_id")


def _bronze(lake: Lake, table: str) -> DataFrame:
    return BatchRun(lake.spark, lake, batch_id="").bronze(table)


def _summary(lake: Lake) -> DataFrame:
    return serving.summary(lake.read(GOLD_KPIS), lake.read(GOLD_CRITICAL),
                           quarantine(lake, SILVER_ADMISSIONS), audit_log(lake))


def _flagged(lake: Lake) -> DataFrame:
    return silver(lake, SILVER_ADMISSIONS).unionByName(quarantine(lake, SILVER_ADMISSIONS))


#: The ten endpoints of the dashboard service.
ENDPOINTS = {
    "summary": _summary,
    "dept-annual": lambda lake: serving.dept_annual(lake.read(GOLD_KPIS)),
    "monthly-trends": lambda lake: serving.monthly_trends(lake.read(GOLD_KPIS)),
    "readmission-risk": lambda lake: serving.readmission_risk(lake.read(GOLD_READMISSIONS)),
    "critical-labs": lambda lake: serving.critical_labs(lake.read(GOLD_CRITICAL)),
    "audit": lambda lake: audit.records_flow(audit_log(lake)).orderBy("finished_at"),
    "insurer-revenue": lambda lake: serving.insurer_revenue(lake.read(GOLD_FINANCE)),
    "cost-tier": lambda lake: serving.cost_tier_mix(lake.read(GOLD_FINANCE)),
    "doctor-alerts": lambda lake: serving.doctor_alerts(lake.read(GOLD_CRITICAL)),
    "quarterly": lambda lake: serving.quarterly(lake.read(GOLD_KPIS)),
}

#: Summaries at the end of a job, and the views of the interactive dashboard.
VIEWS = {
    "load-history": lambda lake: ingest.load_history(_bronze(lake, BRONZE_ADMISSIONS)),
    "write-verify": lambda lake: ingest.write_verify(_bronze(lake, BRONZE_ADMISSIONS),
                                                     "department"),
    "bronze-rejects": lambda lake: lake.read_batches(BRONZE_REJECTS, REJECTS_DDL),
    "dq-summary": lambda lake: quality.dq_summary(_bronze(lake, BRONZE_ADMISSIONS),
                                                  _flagged(lake)),
    "quarantine-breakdown": lambda lake: quality.quarantine_breakdown(_flagged(lake)),
    "expectations": lambda lake: lake.read(EXPECTATIONS),
    "scd2-counts": lambda lake: patient_dim.scd2_counts(
        lake.read(PATIENT_DIM, K.PATIENT_DIM_DDL)),
    "asof-insurer": lambda lake: patient_dim.asof_lookup(
        silver(lake, SILVER_ADMISSIONS).select("admission_id", "patient_id", "admission_date"),
        lake.read(PATIENT_DIM, K.PATIENT_DIM_DDL), ["insurer_name", "valid_from", "valid_to"]),
    "silver-dept-stats": lambda lake: reports.silver_dept_stats(silver(lake, SILVER_ADMISSIONS)),
    "interpretations": lambda lake: reports.interpretation_distribution(silver(lake, SILVER_LABS)),
    "tat-by-test": lambda lake: reports.tat_by_test(silver(lake, SILVER_LABS)),
    "annual-los": lambda lake: reports.annual_los_by_dept(lake.read(GOLD_KPIS)),
    "revenue-by-dept": lambda lake: reports.revenue_by_dept(lake.read(GOLD_FINANCE)),
    "critical-by-test": lambda lake: reports.critical_by_dept_test(lake.read(GOLD_CRITICAL)),
    "annual-summary": lambda lake: reports.annual_dept_summary(lake.read(GOLD_KPIS)),
    "high-risk-groups": lambda lake: reports.high_risk_groups(lake.read(GOLD_READMISSIONS)),
    "critical-departments": lambda lake: reports.critical_departments(lake.read(GOLD_KPIS)),
    "audit-kpis": lambda lake: audit.audit_kpis(audit_log(lake)),
    "overview": lambda lake: serving.overview(lake.read(GOLD_KPIS)),
    "monthly": lambda lake: serving.monthly_admissions(lake.read(GOLD_KPIS)),
    "status-mix": lambda lake: serving.status_mix(lake.read(GOLD_KPIS)),
    "latest-month": lambda lake: serving.latest_month_per_dept(lake.read(GOLD_KPIS)),
    "finance": lambda lake: serving.finance_headline(lake.read(GOLD_FINANCE)),
    "top-dept-insurer": lambda lake: serving.top_dept_insurer(lake.read(GOLD_FINANCE)),
    "quarterly-revenue": lambda lake: serving.quarterly_revenue(lake.read(GOLD_FINANCE)),
    "finance-detail": lambda lake: serving.finance_detail(lake.read(GOLD_FINANCE)),
    "clinical": lambda lake: serving.clinical_headline(lake.read(GOLD_CRITICAL),
                                                       lake.read(GOLD_READMISSIONS)),
    "risk-bubble": lambda lake: serving.risk_bubble(lake.read(GOLD_READMISSIONS)),
    "doctor-alert-table": lambda lake: serving.doctor_alert_table(lake.read(GOLD_CRITICAL)),
    "lab-table": lambda lake: serving.critical_labs_filtered(lake.read(GOLD_CRITICAL)),
    "filter-choices": lambda lake: serving.filter_choices(lake.read(GOLD_CRITICAL)),
    "alert-summary": lambda lake: alert_summary(
        lake.spark.read.parquet(lake.path("bronze/vitals_alerts"))),
    "warehouse": lambda lake: warehouse_export(silver(lake, SILVER_ADMISSIONS)),
    "warehouse-rejects": lambda lake: warehouse_rejects(silver(lake, SILVER_ADMISSIONS)),
}
