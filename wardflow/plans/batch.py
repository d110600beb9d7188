"""The nightly batch: CSV to Bronze to Silver, patient history, Gold, models, checks and audit.

Every stage is a function from DataFrames to DataFrames; this module only reads, writes and
counts. Each stage reads what the one before wrote in the same run, so lineage never spans more
than one stage and a lost executor costs at most the running one. Dashboards read what a run has
published, and a run publishes its tables together, after its checks.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from wardflow import constants as K
from wardflow.operators import admissions as adm
from wardflow.operators import gold, ingest, monthly_state, patient_dim, quality
from wardflow.operators import incremental as merging
from wardflow.operators import labs as lab
from wardflow.operators.dedup import LAB_KEY
from wardflow.operators.profile import PROFILE_DDL, delivery_profile
from wardflow.plans import audit, models
from wardflow.sources import files
from wardflow.sources.keyed import KeyedTable
from wardflow.sources.lake import Lake

# Table folders by layer.
BRONZE_ADMISSIONS = "bronze/admissions"
BRONZE_LABS = "bronze/labs"
BRONZE_REJECTS = "bronze/rejects"
SILVER_ADMISSIONS = "silver/admissions"
SILVER_LABS = "silver/labs"
PATIENT_DIM = "silver/dim_patient"
# Silver that deliveries are merged into, and what a delivery changed in it.
CURRENT = {SILVER_ADMISSIONS: "silver_current/admissions", SILVER_LABS: "silver_current/labs"}
NEW_FACTS = "silver/new_facts"
CORRECTED = "silver/corrected_patients"
TOUCHED_MONTHS = "silver/touched_months"
# What the monthly figures of an incremental run are kept in.
STATE = ["gold/state_sums", "gold/state_patients"]
NUMBERS = "gold/patient_numbers"
GOLD_KPIS = "gold/dept_monthly_kpis"
GOLD_READMISSIONS = "gold/readmission_analysis"
GOLD_FINANCE = "gold/financial_summary"
GOLD_CRITICAL = "gold/critical_labs_watch"
GOLD_LOS = "gold/avg_los_by_department"
GOLD_MART = "gold/mart_dept_monthly_kpis"
AUDIT = "audit/steps"
EXPECTATIONS = "audit/expectations"
PROFILES = "audit/profiles"

# What a run publishes.
TABLES = [SILVER_ADMISSIONS, SILVER_LABS, PATIENT_DIM, GOLD_KPIS, GOLD_READMISSIONS, GOLD_FINANCE,
          GOLD_CRITICAL, GOLD_LOS, GOLD_MART, EXPECTATIONS]

_BRONZE_AUDIT_DDL = ("_ingested_at timestamp, _source string, _source_file string, "
                     "_batch_id string")
REJECTS_DDL = f"raw_line string, first_field string, {_BRONZE_AUDIT_DDL}"
_SILVER_DDL = {SILVER_ADMISSIONS: K.SILVER_ADMISSIONS_DDL, SILVER_LABS: K.SILVER_LABS_DDL}


@dataclass
class BatchRun:
    """One run over one lake. ``keep`` published runs stay when this one is published."""

    spark: SparkSession
    lake: Lake
    batch_id: str
    as_of: Column | None = None
    min_group: int = K.MIN_GROUP
    keep: int = 2
    incremental: bool = False
    steps: list[dict] = field(default_factory=list)
    started: float = field(default_factory=time.monotonic)

    def log(self, step: str, layer: str, records_in: int, records_out: int, notes: str = "",
            status: str = "success"):
        row = dict(step=step, layer=layer, status=status, records_in=records_in,
                   records_out=records_out, elapsed_sec=int(time.monotonic() - self.started),
                   notes=notes)
        self.steps.append(row)
        try:  # a run must not fail because its log could not be written
            audit_row = audit.audit_row(self.spark, **row)
            self.lake.write_batch(audit_row, AUDIT, f"{self.batch_id}.{step}")
        except Exception as problem:  # noqa: BLE001
            print(f"audit row of {step} not written: {problem}")

    # --- bronze ----------------------------------------------------------

    def ingest(self, admissions_csv: str | list[str], labs_csv: str | list[str]) -> None:
        """Well-formed lines go to Bronze, the text of the others to its reject table.

        What the columns of the delivery hold is noted beside, one row per column.
        """
        for step, path, ddl, kinds, table, source, folder in (
            ("ingest_admissions", admissions_csv, K.ADMISSIONS_RAW_DDL, K.ADMISSIONS_KINDS,
             BRONZE_ADMISSIONS, K.ADMISSIONS_SOURCE, "department"),
            ("ingest_labs", labs_csv, K.LABS_RAW_DDL, K.LABS_KINDS, BRONZE_LABS, K.LABS_SOURCE,
             "test_name"),
        ):
            lines = ingest.audit_columns(files.read_csv_lines(self.spark, path, ddl),
                                         self.batch_id, source, source_file=True)
            seen = self.lake.write_batch(files.well_formed(lines), table, self.batch_id, [folder])
            bad = self.lake.write_batch(files.malformed(lines), BRONZE_REJECTS,
                                        f"{self.batch_id}.{source}")["rows"]
            landed = self.bronze(table).filter(F.col("_batch_id") == self.batch_id)
            self.lake.write_batch(
                delivery_profile(landed, kinds).withColumn("source", F.lit(source)), PROFILES,
                f"{self.batch_id}.{source}")
            self.log(step, "bronze", seen["rows"] + bad, seen["rows"],
                     f"rejected={bad}" if bad else "")

    def bronze(self, table: str):
        ddl = K.ADMISSIONS_RAW_DDL if table == BRONZE_ADMISSIONS else K.LABS_RAW_DDL
        return self.lake.read_batches(table, f"{ddl}, {_BRONZE_AUDIT_DDL}")

    def profile(self, source: str):
        """What the columns of this run's delivery hold."""
        return self.lake.read_batches(PROFILES, f"{PROFILE_DDL}, source string, _batch_id string") \
            .filter(F.col("_batch_id") == f"{self.batch_id}.{source}").drop("_batch_id")

    # --- silver ----------------------------------------------------------

    def build_silver(self) -> None:
        """Valid and rejected rows of one pass go to one table, split by the ``outcome`` folder.

        Writing them as two tables would run the deduplication twice or hold it in memory.
        """
        valid = F.count_if(F.col("outcome") == "valid")
        for step, bronze, table, flag in _SILVER_STEPS:
            if kept_current(self.lake, table):
                raise ValueError(f"deliveries are merged into {table} here; run incrementally")
            raw = self.bronze(bronze)
            seen = self.lake.write_version(_with_outcome(flag(raw), self.batch_id), table,
                                           self.batch_id, _FOLDERS[table], valid=valid)
            rejected = seen["rows"] - seen["valid"]
            self.log(step, "silver", raw.count(), seen["valid"], f"quarantined={rejected}")

    def merge_silver(self) -> None:
        """Merge this delivery into Silver: read and rewrite the partitions it touches alone.

        The first time everything in Bronze is the delivery. Readers of Silver see a delivery as
        soon as its partitions are committed; the tables built from it still wait for the checks.
        """
        for step, bronze, table, flag in _SILVER_STEPS:
            raw = self.bronze(bronze)
            if kept_current(self.lake, table):
                raw = raw.filter(F.col("_batch_id") == self.batch_id)
            flagged = flag(raw, newest_first=["_ingested_at", "_batch_id"], keep=("_batch_id",))
            seen = current_silver(self.lake, table).merge(
                _with_outcome(flagged, self.batch_id),
                self._note_changes if table == SILVER_ADMISSIONS else None)
            self.lake.write_version(self.spark.range(1), f"{CURRENT[table]}_merged", self.batch_id)
            self.log(step, "silver", seen["read"], seen["rows"],
                     f"partitions={seen['partitions']}")

    def _note_changes(self, merge) -> None:
        """Facts that are new, and patients of facts that were there before, in either form.

        Noted before the table changes. A run that is repeated adds to what it noted first, since
        by then some partitions may have changed.
        """
        before, after = merge.before.select("admission_id", "patient_id"), merge.after
        valid = after.filter(F.col("outcome") == "valid")
        new = valid.join(before.select("admission_id").na.drop(), "admission_id", "left_anti")
        again = after.select("admission_id", "patient_id").join(
            before.select("admission_id").na.drop(), "admission_id", "left_semi")
        corrected = before.unionByName(again).select("patient_id")
        if self.lake.has_version(CORRECTED, self.batch_id):
            corrected = corrected.unionByName(
                self.lake.read(CORRECTED, "patient_id string", self.batch_id))
        months = merge.before.select("department", "admission_date").unionByName(
            after.select("department", "admission_date")).select(
            "department", F.trunc("admission_date", "MM").alias("month")).na.drop()
        if self.lake.has_version(TOUCHED_MONTHS, self.batch_id):
            months = months.unionByName(
                self.lake.read(TOUCHED_MONTHS, "department string, month date", self.batch_id))
        self.lake.write_version(corrected.distinct(), CORRECTED, self.batch_id)
        self.lake.write_version(months.distinct(), TOUCHED_MONTHS, self.batch_id)
        self.lake.write_version(new.select(
            "patient_id", "admission_id", "admission_date", *patient_dim.ATTRIBUTES), NEW_FACTS,
            self.batch_id)

    def silver(self, table: str):
        """Valid rows of this run; the filter prunes folders."""
        return silver(self.lake, table, self.batch_id)

    def quarantine(self, table: str):
        """Rejected rows of this run. Silver is built from all of Bronze, so they accumulate."""
        return quarantine(self.lake, table, self.batch_id)

    def patient_dim(self):
        return self.lake.read(PATIENT_DIM, K.PATIENT_DIM_DDL, self.batch_id)

    def build_patient_dim(self) -> None:
        """Merge into the published dimension, or build it from all valid facts the first time.

        Patients whose facts this delivery adds or replaces are rebuilt from all their facts; the
        versions of all others are taken over. A fact that changed its patient, was corrected or
        is now rejected touches the patients of its old and its new form. An incremental run
        knows which facts are new: patients that have only such go on from their current version.
        """
        facts = self.silver(SILVER_ADMISSIONS)
        if PATIENT_DIM in self.lake.published() and self.incremental:
            dim = patient_dim.scd2_load(
                self.lake.read(PATIENT_DIM, K.PATIENT_DIM_DDL),
                self.lake.read(NEW_FACTS, version=self.batch_id), facts,
                corrected=self.lake.read(CORRECTED, "patient_id string", self.batch_id))
        elif PATIENT_DIM in self.lake.published():
            keys = self.bronze(BRONZE_ADMISSIONS).filter(
                F.col("_batch_id") == self.batch_id).select("admission_id").distinct()
            before = silver(self.lake, SILVER_ADMISSIONS).select("admission_id", "patient_id")
            now = facts.select("admission_id", "patient_id")
            touched = before.unionByName(now).join(keys, "admission_id", "left_semi") \
                .select("patient_id").distinct()
            dim = patient_dim.rebuild_patients(
                self.lake.read(PATIENT_DIM, K.PATIENT_DIM_DDL), facts, touched)
        else:
            dim = patient_dim.scd2_history(facts)
        seen = self.lake.write_version(dim, PATIENT_DIM, self.batch_id, ["is_current"])
        self.log("scd2_patient_dim", "silver", facts.count(), seen["rows"])

    # --- gold ------------------------------------------------------------

    def monthly_kpis(self, facts):
        """Monthly figures; an incremental run counts only the months that its delivery touches."""
        if not self.incremental:
            return gold.dept_monthly_kpis(facts)
        published, known = self.lake.published(), None
        if NUMBERS in published:
            months = self.lake.read(TOUCHED_MONTHS, "department string, month date", self.batch_id)
            # At most as many rows as there are folders; the filter prunes them.
            folders = [r.asDict() for r in months.select(
                "department", F.year("month").alias("admission_year")).distinct().collect()]
            known = self.lake.read(NUMBERS)
            facts = merging.in_partitions(facts, folders).join(
                months.withColumnRenamed("department", "_department"),
                (F.col("department") == F.col("_department"))
                & (F.trunc("admission_date", "MM") == F.col("month")), "left_semi")
        self.lake.write_version(monthly_state.number_patients(facts, known), NUMBERS,
                                self.batch_id)
        state = monthly_state.monthly_state(
            facts, self.lake.read(NUMBERS, version=self.batch_id))
        if known is not None:
            before = monthly_state.MonthlyState(*[self.lake.read(t) for t in STATE])
            state = monthly_state.replaced_months(before, months, state)
        for rows, table in zip(state, STATE):
            self.lake.write_version(rows, table, self.batch_id)
        return monthly_state.kpis_from_state(monthly_state.MonthlyState(
            *[self.lake.read(t, version=self.batch_id) for t in STATE]))

    def build_gold(self) -> None:
        facts, results = self.silver(SILVER_ADMISSIONS), self.silver(SILVER_LABS)
        n_facts, n_results = facts.count(), results.count()
        sql = models.build_models(self.spark, facts)
        for step, table, rows, records_in in (
            ("build_dept_kpis", GOLD_KPIS, self.monthly_kpis(facts), n_facts),
            ("build_readmission_analysis", GOLD_READMISSIONS,
             gold.readmission_analysis(facts, self.min_group), n_facts),
            ("build_financial_summary", GOLD_FINANCE, gold.financial_summary(facts), n_facts),
            ("build_critical_labs_watch", GOLD_CRITICAL,
             gold.critical_labs_watch(results, facts, self.as_of), n_results),
            ("avg_los_by_department", GOLD_LOS, sql["avg_los_by_department"], n_facts),
            ("mart_dept_monthly_kpis", GOLD_MART, sql["mart_dept_monthly_kpis"], n_facts),
        ):
            seen = self.lake.write_version(gold.with_built_at(rows), table, self.batch_id)
            self.log(step, "gold", records_in, seen["rows"])

    # --- checks ----------------------------------------------------------

    def check(self) -> None:
        """Write every expectation's result, then raise if a condition of the run fails.

        The run depends on the gates, on freshness and on the admission and lab expectations;
        results for models are there to read. Only after that are the run's tables published, and
        runs that nobody needs any more expired.
        """
        facts = self.silver(SILVER_ADMISSIONS)
        kpis = self.lake.read(GOLD_KPIS, version=self.batch_id)
        monthly = self.lake.read(GOLD_LOS, version=self.batch_id)
        tested = (
            quality.evaluate(facts, SILVER_ADMISSIONS, quality.admission_expectations())
            .unionByName(quality.evaluate(self.silver(SILVER_LABS), SILVER_LABS,
                                          quality.lab_expectations()))
            .unionByName(quality.evaluate(monthly, GOLD_LOS,
                                          quality.kpi_expectations(K.DEPARTMENTS))))
        self.lake.write_version(tested, EXPECTATIONS, self.batch_id)
        quality.require(quality.quality_gates(facts, kpis), "passed")
        quality.require(quality.freshness_check(monthly), "is_fresh")
        on_silver = self.lake.read(EXPECTATIONS, version=self.batch_id).filter(
            F.col("table_name").isin(SILVER_ADMISSIONS, SILVER_LABS)
            & (F.col("column_name") != "admission_id")
            | (F.col("table_name") == SILVER_ADMISSIONS))
        quality.require(on_silver.withColumn("passed", F.col("failures") == 0), "passed")
        tables = TABLES
        if self.incremental:
            tables = [t for t in TABLES if t not in CURRENT] + [*STATE, NUMBERS]
        self.lake.publish(self.batch_id, tables)
        self.lake.expire(self.keep)


_FOLDERS = {SILVER_ADMISSIONS: ["outcome", "department", "admission_year"],
            SILVER_LABS: ["outcome", "test_name"]}
_KEYS = {SILVER_ADMISSIONS: ["admission_id"], SILVER_LABS: LAB_KEY}
_SILVER_STEPS = [
    ("transform_admissions", BRONZE_ADMISSIONS, SILVER_ADMISSIONS, adm.flagged_admissions),
    ("transform_labs", BRONZE_LABS, SILVER_LABS, lab.flagged_labs),
]


def _with_outcome(flagged, batch_id: str):
    return adm.with_lineage(flagged, batch_id).withColumn(
        "outcome", F.when(F.col("dq_flag") == K.VALID, "valid").otherwise("rejected"))


def kept_current(lake: Lake, table: str) -> bool:
    """Whether deliveries are merged into this Silver table, instead of rebuilding it."""
    return lake.exists(f"{CURRENT[table]}_merged")


def current_silver(lake: Lake, table: str) -> KeyedTable:
    buckets = int(lake.spark.conf.get("spark.sql.shuffle.partitions"))
    return KeyedTable(lake.spark, lake.path(CURRENT[table]),
                      f"{_SILVER_DDL[table]}, _batch_id string", _KEYS[table], _FOLDERS[table],
                      buckets)


def _silver(lake: Lake, table: str, version: str | None):
    if kept_current(lake, table):
        return current_silver(lake, table).read().drop("_batch_id")
    return lake.read(table, _SILVER_DDL[table], version)


def silver(lake: Lake, table: str, version: str | None = None):
    """Valid Silver rows: current ones if deliveries are merged, else published ones or a run's."""
    return _silver(lake, table, version).filter(F.col("outcome") == "valid").drop("outcome")


def quarantine(lake: Lake, table: str, version: str | None = None):
    """Rejected Silver rows, of the same version."""
    return _silver(lake, table, version).filter(F.col("outcome") == "rejected").drop("outcome")


STAGES = ["ingest", "build_silver", "build_patient_dim", "build_gold", "check"]


def run_batch(spark: SparkSession, lake: Lake, batch_id: str,
              admissions_csv: str | list[str], labs_csv: str | list[str],
              as_of: Column | None = None, min_group: int = K.MIN_GROUP, keep: int = 2,
              stages: list[str] | None = None, incremental: bool = False) -> BatchRun:
    """Run the stages for one delivery. Repeating a batch id, or a stage, supersedes its output.

    ``incremental`` merges the delivery into Silver instead of rebuilding Silver from all of
    Bronze; a lake that was run so once stays so.
    """
    run = BatchRun(spark, lake, batch_id, as_of, min_group, keep, incremental)
    for stage in stages or STAGES:
        if stage == "build_silver" and incremental:
            stage = "merge_silver"
        try:
            if stage == "ingest":
                run.ingest(admissions_csv, labs_csv)
            else:
                getattr(run, stage)()
        except Exception as problem:
            run.log(stage, "run", 0, 0, str(problem), status="failure")
            raise
    return run
