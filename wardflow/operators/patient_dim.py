"""Type-2 patient dimension: snapshot, merge, whole history and as-of lookup.

Validity is by business date, in closed intervals: a version ends the day before the next one
begins, and the open one ends on 9999-12-31. Two different states on one day collapse to the one
of the highest fact id.

Every per-patient window runs on at most one row per patient and day, reduced before the
exchange. That bounds what one task can receive for one patient by the number of calendar days,
even when that patient holds a third of the facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow import constants as K

KEY = "patient_id"
ATTRIBUTES = ["age", "gender", "insurance_id", "insurer_name"]
TRACKED = ["insurance_id", "insurer_name"]
VALIDITY = ["valid_from", "valid_to", "is_current"]
DIM_COLUMNS = [KEY, *ATTRIBUTES, "total_admissions", "last_admission_date", *VALIDITY]


def _open_end() -> Column:
    return F.lit(K.OPEN_END).cast("date")


def patient_snapshot(admissions: DataFrame, attributes: list[str] | None = None,
                     date: str = "admission_date", fact_id: str = "admission_id") -> DataFrame:
    """One row per patient: the last non-null value of each attribute by date, then fact id."""
    order = F.struct(date, fact_id)
    latest = [F.max_by(a, F.when(F.col(a).isNotNull(), order)).alias(a)
              for a in attributes or ATTRIBUTES]
    return admissions.groupBy(KEY).agg(
        *latest,
        F.count(F.lit(1)).alias("total_admissions"),
        F.max(date).alias("last_admission_date"),
    )


def scd2_initial(snapshot: DataFrame, effective: str = "last_admission_date") -> DataFrame:
    """First load: every snapshot row becomes the open version of its patient."""
    return snapshot.withColumns({
        "valid_from": F.col(effective), "valid_to": _open_end(), "is_current": F.lit(True)})


def _changed(tracked: list[str], old: str, new: str) -> Column:
    same = F.lit(True)
    for column in tracked:
        same = same & F.col(f"{old}.{column}").eqNullSafe(F.col(f"{new}.{column}"))
    return ~same


def scd2_merge(dim: DataFrame, snapshot: DataFrame, tracked: list[str] | None = None,
               effective: str = "last_admission_date") -> DataFrame:
    """Merge one snapshot into the dimension: expire changed versions and open their successors.

    A snapshot knows the last state of a patient only; a load of facts with several changes, or
    with totals that go on counting, is merged by ``scd2_load``.

    Only current rows take part in the join; closed versions pass through unshuffled. Unchanged
    patients keep their row as it is, so merging the same snapshot twice changes nothing. A
    change effective on the day the current version began replaces that version, since it would
    end before it began. A snapshot older than the current version leaves it alone; find those
    with ``late_patients`` and rebuild them with ``rebuild_patients``.
    """
    tracked = tracked or TRACKED
    columns = dim.columns
    opened = scd2_initial(snapshot, effective).select(*columns)
    old = dim.filter(F.col("is_current")).select(
        F.col(KEY).alias("_old_key"), F.struct(*columns).alias("old"))
    new = opened.select(F.col(KEY).alias("_new_key"), F.struct(*columns).alias("new"))

    starts_later = F.col("new.valid_from") > F.col("old.valid_from")
    same_day = F.col("new.valid_from") == F.col("old.valid_from")
    expired = F.struct(*[
        F.date_sub(F.col("new.valid_from"), 1).alias(c) if c == "valid_to"
        else F.lit(False).alias(c) if c == "is_current"
        else F.col(f"old.{c}").alias(c) for c in columns])
    versions = (
        F.when(F.col("_old_key").isNull(), F.array("new"))
        .when(F.col("_new_key").isNull(), F.array("old"))
        .when(_changed(tracked, "old", "new") & starts_later, F.array(expired, F.col("new")))
        .when(_changed(tracked, "old", "new") & same_day, F.array("new"))
        .otherwise(F.array("old")))
    current = (old.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer")
               .select(F.inline(versions)))
    return dim.filter(~F.col("is_current")).unionByName(current.select(*columns))


def late_patients(dim: DataFrame, facts: DataFrame, date: str = "admission_date") -> DataFrame:
    """Patients with a new fact dated before their current version began."""
    first = facts.groupBy(KEY).agg(F.min(date).alias("_first"))
    current = dim.filter(F.col("is_current")).select(KEY, "valid_from")
    return (first.join(current, KEY).filter(F.col("_first") < F.col("valid_from")).select(KEY))


def _same_patient(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on the patient; NULL is a patient like any other. ``right`` has a row per patient."""
    renamed = right.withColumnRenamed(KEY, "_patient")
    joined = left.join(renamed, F.col(KEY).eqNullSafe(F.col("_patient")), how)
    return joined.drop("_patient") if how in ("inner", "left") else joined


def rebuild_patients(dim: DataFrame, facts: DataFrame, patients: DataFrame,
                     tracked: list[str] | None = None) -> DataFrame:
    """Replace the versions of ``patients`` with their history recomputed from all facts."""
    rebuilt = scd2_history(_same_patient(facts, patients, "left_semi"), tracked)
    return _same_patient(dim, patients, "left_anti").unionByName(rebuilt.select(*dim.columns))


def _day_states(facts: DataFrame, attributes: list[str], date: str, fact_id: str) -> DataFrame:
    """One row per patient and day: the state of the highest fact id, and how many facts."""
    return (
        facts.filter(F.col(date).isNotNull()).groupBy(KEY, F.col(date).alias("day"))
        .agg(F.max_by(F.struct(*attributes), F.col(fact_id)).alias("state"),
             F.count(F.lit(1)).alias("n"))
        .withColumn("start", F.col("day")))


def _versions(day_states: DataFrame, tracked: list[str]) -> DataFrame:
    """Runs of days with the same tracked state (gaps and islands), as dimension rows."""
    by_day = Window.partitionBy(KEY).orderBy("day")
    before = F.lag("state").over(by_day)
    islands = (
        day_states.withColumn("before", before)
        .withColumn("starts", F.col("before").isNull() | _changed(tracked, "before", "state"))
        .withColumn("island", F.sum(F.col("starts").cast("int")).over(
            by_day.rowsBetween(Window.unboundedPreceding, 0))))
    versions = islands.groupBy(KEY, "island").agg(
        F.min("start").alias("valid_from"), F.max("day").alias("last_admission_date"),
        F.max_by("state", "day").alias("state"), F.sum("n").alias("n"))
    by_version = Window.partitionBy(KEY).orderBy("island")
    following = F.lead("valid_from").over(by_version)
    return versions.select(
        KEY, "state.*",
        F.sum("n").over(by_version.rowsBetween(Window.unboundedPreceding, 0))
        .alias("total_admissions"),
        "last_admission_date", "valid_from",
        F.coalesce(F.date_sub(following, 1), _open_end()).alias("valid_to"),
        following.isNull().alias("is_current"))


def scd2_history(facts: DataFrame, tracked: list[str] | None = None,
                 attributes: list[str] | None = None, date: str = "admission_date",
                 fact_id: str = "admission_id") -> DataFrame:
    """Every version of every patient in one pass over the facts.

    ``total_admissions`` counts up to the end of the version; other attributes are those of its
    last day.
    """
    return _versions(_day_states(facts, attributes or ATTRIBUTES, date, fact_id),
                     tracked or TRACKED)


def scd2_load(dim: DataFrame, new_facts: DataFrame, all_facts: DataFrame,
              tracked: list[str] | None = None, attributes: list[str] | None = None,
              date: str = "admission_date", fact_id: str = "admission_id",
              corrected: DataFrame | None = None) -> DataFrame:
    """The dimension after a load of new facts: the history of all facts, at the cost of the load.

    Only patients of the load are touched; a missing patient id is one of them. Where all their
    new facts are later than what the current version has seen, the current version goes on as if
    it were one day of facts: it may be extended, or closed by any number of new versions, and
    totals keep counting. A patient with an older or equally dated fact, or named by
    ``corrected`` because a fact seen before has changed, is rebuilt from ``all_facts``, which
    include the new ones. Closed versions and untouched patients pass through.

    Every patient is marked once; what goes on and what is rebuilt then share one window.
    """
    tracked, attributes = tracked or TRACKED, attributes or ATTRIBUTES
    dated = new_facts.filter(F.col(date).isNotNull())
    current = dim.filter(F.col("is_current")).select(KEY, F.col("last_admission_date").alias("_seen"))
    first = dated.groupBy(KEY).agg(F.min(date).alias("_first"))
    marks = _same_patient(first, current, "left").select(
        KEY, F.coalesce(F.col("_first") <= F.col("_seen"), F.lit(False)).alias("_rebuild"))
    if corrected is not None:
        named = corrected.select(KEY).distinct().withColumn("_rebuild", F.lit(True))
        marks = marks.unionByName(named).groupBy(KEY).agg(F.max("_rebuild").alias("_rebuild"))

    marked = _same_patient(dim, marks, "left")
    goes_on = F.col("_rebuild").eqNullSafe(F.lit(False))
    kept = marked.filter(F.col("_rebuild").isNull() | (goes_on & ~F.col("is_current")))
    seeds = marked.filter(goes_on & F.col("is_current")).select(
        KEY, F.col("last_admission_date").alias("day"), F.struct(*attributes).alias("state"),
        F.col("total_admissions").alias("n"), F.col("valid_from").alias("start"))
    needed = [KEY, date, fact_id, *attributes]
    facts = _same_patient(dated.select(*needed), marks.filter(goes_on), "left_semi").unionByName(
        _same_patient(all_facts.select(*needed), marks.filter("_rebuild"), "left_semi"))
    days = _day_states(facts, attributes, date, fact_id)
    return kept.select(*dim.columns).unionByName(
        _versions(seeds.unionByName(days), tracked).select(*dim.columns))


def scd2_counts(dim: DataFrame) -> DataFrame:
    return dim.agg(F.count(F.lit(1)).alias("total_versions"),
                   F.count_if(F.col("is_current")).alias("current_versions"),
                   F.count_if(~F.col("is_current")).alias("expired_versions"))


def asof_lookup(facts: DataFrame, dim: DataFrame, columns: list[str],
                date: str = "admission_date") -> DataFrame:
    """Each fact with the dimension ``columns`` valid on its date; no fact is lost or doubled.

    A plain range join pairs every fact of a patient with every version of that patient before
    the dates are compared, quadratic in a busy patient. Here the distinct (patient, day) pairs
    are looked up instead: versions and days meet in one window that carries the last version
    forward, at most two rows per patient and calendar day, and the facts then join on
    (patient, day), where a busy patient is already spread over its days.
    """
    version = F.struct(F.col("valid_to").alias("_until"), *columns)
    starts = dim.select(KEY, F.col("valid_from").alias("day"), version.alias("version"))
    days = (facts.filter(F.col(date).isNotNull())
            .select(KEY, F.col(date).alias("day")).distinct()
            .withColumn("version", F.lit(None).cast(starts.schema["version"].dataType)))
    carried = F.last("version", ignorenulls=True).over(
        Window.partitionBy(KEY).orderBy("day", F.col("version").isNull())
        .rowsBetween(Window.unboundedPreceding, 0))
    looked_up = (
        starts.withColumn("wanted", F.lit(False))
        .unionByName(days.withColumn("wanted", F.lit(True)))
        .withColumn("found", carried)
        .filter(F.col("wanted") & (F.col("day") <= F.col("found._until")))
        .select(KEY, F.col("day").alias(date), *[F.col(f"found.{c}") for c in columns]))
    return facts.join(looked_up, [KEY, date], "left")
