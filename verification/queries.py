"""Every registered query: ``(spark, sf_dir) -> DataFrame`` over the whole supplied tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verification import bindings as B
from wardflow import constants as K
from wardflow.functions.parsing import iso_date
from wardflow.operators import admissions as adm
from wardflow.operators import (dedup, gold, ingest, monthly_state, patient_dim, quality,
                                reports)
from wardflow.operators import labs as lab
from wardflow.operators.profile import delivery_profile
from wardflow.plans import audit, models, serving
from wardflow.session import shared_folder
from wardflow.sources.keyed import KeyedTable
from wardflow.sources.warehouse import warehouse_export, warehouse_rejects
from wardflow.streaming import vitals

# A first and a second load for the merge.
SECOND_LOAD_FROM = "1998-01-01"
FRESH_WITHIN_DAYS = 3650


class Layers:
    """The layers over one folder of supplied tables; nothing runs until a query is collected."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def bronze(self) -> DataFrame:
        return B.admissions(self.spark, self.sf_dir)

    @cached_property
    def deliveries(self) -> DataFrame:
        return B.admission_deliveries(self.spark, self.sf_dir)

    @cached_property
    def bronze_labs(self) -> DataFrame:
        return B.labs(self.spark, self.sf_dir)

    @cached_property
    def flagged(self) -> DataFrame:
        return adm.flagged_admissions(self.bronze)

    @cached_property
    def valid(self) -> DataFrame:
        return quality.accepted(self.flagged)

    @cached_property
    def flagged_labs(self) -> DataFrame:
        rows = lab.flagged_labs(self.bronze_labs, tie_break=B.LAB_TIE_BREAK)
        return rows.drop(*B.LAB_TIE_BREAK)

    @cached_property
    def valid_labs(self) -> DataFrame:
        return quality.accepted(self.flagged_labs)

    @cached_property
    def kpis(self) -> DataFrame:
        return gold.dept_monthly_kpis(self.valid)

    @cached_property
    def readmissions(self) -> DataFrame:
        return gold.readmission_analysis(self.valid)

    @cached_property
    def finance(self) -> DataFrame:
        return gold.financial_summary(self.valid)

    @cached_property
    def critical(self) -> DataFrame:
        return gold.critical_labs_watch(
            self.valid_labs, self.valid, F.lit(B.AS_OF).cast("timestamp"))

    def model(self, name: str) -> DataFrame:
        return models.build_models(self.spark, self.flagged, only=name)[name]

    @cached_property
    def facts(self) -> DataFrame:
        return B.insurance_facts(self.spark, self.sf_dir)

    @cached_property
    def merged_dim(self) -> DataFrame:
        date = F.col("admission_date")
        # The second load has all later facts, several per patient, and some that come late.
        second = (date >= F.lit(SECOND_LOAD_FROM).cast("date")) | (F.col("admission_id") % 5 == 0)
        dim = patient_dim.scd2_history(self.facts.filter(~second), ["insurer_name"])
        return patient_dim.scd2_load(dim, self.facts.filter(second), self.facts, ["insurer_name"])

    @cached_property
    def insurer_history(self) -> DataFrame:
        return patient_dim.scd2_history(self.facts, tracked=["insurer_name"])

    @cached_property
    def rebuilt_after_late_facts(self) -> DataFrame:
        """A dimension built from the later facts, once the earlier ones have arrived late."""
        date, split = F.col("admission_date"), F.lit(SECOND_LOAD_FROM).cast("date")
        dim = patient_dim.scd2_history(self.facts.filter(date >= split), ["insurer_name"])
        late = patient_dim.late_patients(dim, self.facts.filter(date < split))
        return patient_dim.rebuild_patients(dim, self.facts, late, ["insurer_name"])

    @cached_property
    def messages(self) -> DataFrame:
        return B.vital_messages(self.spark, self.sf_dir)

    @cached_property
    def parsed_vitals(self) -> DataFrame:
        return vitals.parse_vitals(self.messages)

    @cached_property
    def alerts(self) -> DataFrame:
        return vitals.vitals_alerts(self.parsed_vitals)

    @cached_property
    def reconciliation(self) -> DataFrame:
        return audit.layer_reconciliation(
            self.bronze, self.bronze_labs, self.flagged, self.flagged_labs, {
                "build_dept_kpis": self.kpis,
                "build_readmission_analysis": self.readmissions,
                "build_financial_summary": self.finance,
                "build_critical_labs_watch": self.critical,
            }, {"build_critical_labs_watch"})


def comparable(rows: DataFrame) -> DataFrame:
    """Render what engines print differently: dates and times as ISO text, decimals as doubles."""
    def rendered(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        return column.alias(field.name)
    return rows.select(*[rendered(f) for f in rows.schema.fields])


def _silver_incremental(d: Layers) -> DataFrame:
    """Silver after two deliveries, each merged into the partitions it touches."""
    flagged = [adm.flagged_admissions(rows, ["_ingested_at", "_batch_id"], keep=("_batch_id",))
               .withColumn("outcome", F.when(F.col("dq_flag") == K.VALID, "valid")
                           .otherwise("rejected"))
               for rows in B.corrected_deliveries(d.spark, d.sf_dir)]
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in flagged[0].schema.fields)
    table = KeyedTable(d.spark, f"{shared_folder(d.spark)}/wardflow-silver-{uuid.uuid4().hex}",
                       ddl, ["admission_id"], ["outcome", "department"], buckets=4)
    for rows in flagged:
        table.merge(rows)
    return table.read().filter("outcome = 'valid'").drop("outcome", "_ingested_at", "_batch_id")


def _kpis_from_state(d: Layers) -> DataFrame:
    """Monthly figures from the states of two halves of the facts, merged; no month is recounted."""
    half = F.col("admission_id") % 2 == 0
    parts = [d.valid.filter(half), d.valid.filter(~half)]
    known = monthly_state.number_patients(parts[0])
    numbers = monthly_state.number_patients(d.valid, known)
    return monthly_state.kpis_from_state(monthly_state.merged(
        *[monthly_state.monthly_state(part, numbers) for part in parts]))


def _scd2_without_id(d: Layers) -> DataFrame:
    """The dimension after two loads in which a part of the facts has no patient."""
    missing = F.when(F.col("patient_id") % 10 != 0, F.col("patient_id"))
    facts = d.facts.withColumn("patient_id", missing)
    second = ((F.col("admission_date") >= F.lit(SECOND_LOAD_FROM).cast("date"))
              | (F.col("admission_id") % 1000 == 0))
    dim = patient_dim.scd2_history(facts.filter(~second), ["insurer_name"])
    return patient_dim.scd2_load(dim, facts.filter(second), facts, ["insurer_name"])


def _last_three_loads(d: Layers) -> DataFrame:
    """Admissions as monthly loads: the month is the batch, the admission day its arrival."""
    parsed = iso_date("admission_date")
    dated = d.bronze.withColumns({
        "_batch_id": F.coalesce(F.date_format(parsed, "yyyyMM"), F.lit("undated")),
        "_ingested_at": parsed.cast("timestamp")})
    return ingest.load_history(dated)


def _freshness(d: Layers) -> DataFrame:
    return quality.freshness_check(d.model("avg_los_by_department"),
                                   as_of=F.lit(B.AS_OF).cast("date"),
                                   max_age_days=FRESH_WITHIN_DAYS)


def _asof(d: Layers) -> DataFrame:
    facts = d.facts.select("admission_id", "patient_id", "admission_date",
                           F.col("insurer_name").alias("billed_insurer"))
    return patient_dim.asof_lookup(
        facts, d.insurer_history, ["insurer_name", "valid_from", "valid_to"])


_HISTORY = ["patient_id", "insurer_name", "total_admissions", "last_admission_date",
            "valid_from", "valid_to", "is_current"]

_BUILDERS: dict[str, Callable[[Layers], DataFrame]] = {
    # ingest
    "bronze_ingest": lambda d: ingest.audit_columns(
        d.bronze, B.BATCH, K.ADMISSIONS_SOURCE).drop("_ingested_at"),
    "write_verify": lambda d: ingest.write_verify(d.bronze, "department"),
    "load_history": _last_three_loads,
    "delivery_profile": lambda d: delivery_profile(d.bronze, K.ADMISSIONS_KINDS),
    "warehouse_export": lambda d: warehouse_export(adm.with_lineage(
        d.valid, B.BATCH)).drop("_silver_processed_at"),
    "warehouse_rejects": lambda d: warehouse_rejects(adm.with_lineage(
        B.widened(d.valid), B.BATCH)).select("admission_id", "misfit_columns"),
    # cleaning
    "dedup_admissions": lambda d: dedup.latest_per_key(
        d.deliveries, ["admission_id"], ["_ingested_at", "_batch_id"]).select(
        "admission_id", "num_procedures", "_ingested_at", "_batch_id"),
    "dedup_labs": lambda d: dedup.latest_per_key(
        d.bronze_labs, dedup.LAB_KEY, [], B.LAB_TIE_BREAK),
    "dedup_labs_compat": lambda d: dedup.latest_per_key(
        d.bronze_labs, dedup.LAB_KEY_COMPAT, [], B.LAB_TIE_BREAK),
    "silver_admissions": lambda d: d.valid,
    "silver_incremental": _silver_incremental,
    "silver_labs": lambda d: d.valid_labs,
    "stg_admissions": lambda d: d.model("stg_admissions"),
    # quality
    "dq_flag_admissions": lambda d: d.flagged.select(
        "admission_id", "length_of_stay_days", "age", "total_cost_usd", "dq_flag"),
    "dq_flag_labs": lambda d: d.flagged_labs.select(
        "lab_id", "marker", "result_value", "tat_minutes", "dq_flag"),
    "quarantine_admissions": lambda d: quality.quarantined(d.flagged),
    "quarantine_labs": lambda d: quality.quarantined(d.flagged_labs),
    "quarantine_breakdown": lambda d: quality.quarantine_breakdown(d.flagged),
    "dq_summary": lambda d: quality.dq_summary(d.deliveries, adm.flagged_admissions(d.deliveries)),
    "expectations_admissions": lambda d: quality.evaluate(
        d.flagged, "silver.admissions", quality.admission_expectations()),
    "expectations_labs": lambda d: quality.evaluate(
        d.flagged_labs, "silver.labs", quality.lab_expectations()),
    "expectations_kpis": lambda d: quality.evaluate(
        d.model("avg_los_by_department"), "gold.avg_los_by_department",
        quality.kpi_expectations(B.DEPARTMENTS)),
    "quality_gates": lambda d: quality.quality_gates(d.valid, d.kpis),
    "freshness_check": _freshness,
    # gold and summaries
    "dept_monthly_kpis": lambda d: d.kpis,
    "kpis_from_state": _kpis_from_state,
    "readmission_analysis": lambda d: d.readmissions,
    "financial_summary": lambda d: d.finance,
    "critical_labs_watch": lambda d: d.critical,
    "silver_dept_stats": lambda d: reports.silver_dept_stats(d.valid),
    "interpretation_distribution": lambda d: reports.interpretation_distribution(d.valid_labs),
    "tat_by_test": lambda d: reports.tat_by_test(d.valid_labs),
    "annual_los_by_dept": lambda d: reports.annual_los_by_dept(d.kpis),
    "revenue_by_dept": lambda d: reports.revenue_by_dept(d.finance),
    "critical_by_dept_test": lambda d: reports.critical_by_dept_test(d.critical),
    "annual_dept_summary": lambda d: reports.annual_dept_summary(d.kpis),
    "high_risk_groups": lambda d: reports.high_risk_groups(d.readmissions),
    "critical_departments": lambda d: reports.critical_departments(d.kpis),
    # SQL models
    "avg_los_by_department": lambda d: d.model("avg_los_by_department"),
    "mart_dept_monthly_kpis": lambda d: d.model("mart_dept_monthly_kpis"),
    # patient history
    "patient_snapshot": lambda d: patient_dim.patient_snapshot(d.valid),
    "scd2_initial": lambda d: patient_dim.scd2_initial(patient_dim.patient_snapshot(d.facts)),
    "scd2_merge": lambda d: d.merged_dim.select(*_HISTORY),
    "scd2_missing_ids": lambda d: _scd2_without_id(d).select(*_HISTORY),
    "scd2_history": lambda d: d.insurer_history.select(*_HISTORY),
    "scd2_late_rebuild": lambda d: d.rebuilt_after_late_facts.select(*_HISTORY),
    "scd2_counts": lambda d: patient_dim.scd2_counts(d.insurer_history),
    "asof_insurer_join": _asof,
    # vital signs
    "vitals_parse": lambda d: d.parsed_vitals,
    "vitals_dead_letters": lambda d: vitals.dead_letters(d.messages),
    "vitals_alerts": lambda d: d.alerts,
    "vitals_alert_summary": lambda d: vitals.alert_summary(d.alerts),
    # service endpoints
    "serve_summary": lambda d: serving.summary(
        d.kpis, d.critical, quality.quarantined(d.flagged)),
    "serve_dept_annual": lambda d: serving.dept_annual(d.kpis),
    "serve_monthly_trends": lambda d: serving.monthly_trends(d.kpis),
    "serve_readmission_risk": lambda d: serving.readmission_risk(d.readmissions),
    "serve_critical_labs": lambda d: serving.critical_labs(d.critical),
    "serve_insurer_revenue": lambda d: serving.insurer_revenue(d.finance),
    "cost_tier_mix": lambda d: serving.cost_tier_mix(d.finance),
    "serve_doctor_alerts": lambda d: serving.doctor_alerts(d.critical),
    "serve_quarterly": lambda d: serving.quarterly(d.kpis),
    # dashboard views
    "shiny_overview": lambda d: serving.overview(d.kpis),
    "shiny_monthly": lambda d: serving.monthly_admissions(d.kpis),
    "shiny_status_mix": lambda d: serving.status_mix(d.kpis),
    "latest_month_per_dept": lambda d: serving.latest_month_per_dept(d.kpis),
    "shiny_finance": lambda d: serving.finance_headline(d.finance),
    "top_dept_insurer": lambda d: serving.top_dept_insurer(d.finance),
    "shiny_quarterly_revenue": lambda d: serving.quarterly_revenue(d.finance),
    "shiny_finance_detail": lambda d: serving.finance_detail(d.finance),
    "shiny_clinical": lambda d: serving.clinical_headline(d.critical, d.readmissions),
    "shiny_risk_bubble": lambda d: serving.risk_bubble(d.readmissions),
    "shiny_doctor_alerts": lambda d: serving.doctor_alert_table(d.critical),
    "critical_labs_filtered": lambda d: serving.critical_labs_filtered(
        d.critical, department="1-URGENT", test_name="All", lab_status="FINAL"),
    "filter_choices": lambda d: serving.filter_choices(d.critical),
    # audit
    "layer_reconciliation": lambda d: d.reconciliation,
    "audit_kpis": lambda d: audit.audit_kpis(d.reconciliation),
}


def _registered(build: Callable[[Layers], DataFrame]):
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(Layers(spark, sf_dir)))
    return run


QUERIES = {name: _registered(build) for name, build in _BUILDERS.items()}
