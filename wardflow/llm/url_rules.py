"""URL filters by a sort-merge range join of reversed-host keys with prefix rules.

A host is turned round label by label, ``www.example.com`` into ``com/example/www/``, so that a
rule's host and all its subdomains are one interval of keys: those that begin with the rule's key.
The ends of all intervals cut the key space into segments, and inside a segment the same nested
rule hosts are active: the stack of a sorted sweep. Distinct hosts and segment starts are sorted
together, range-partitioned, and the sweep carries the last stack forward; what a partition starts
with comes from the last segment start before it.

A stack holds, for each active host, only the lengths that its rules' paths have. A path is cut to
each of these lengths and looked up among the host's rules by an equi-join, so a host with a great
many rules is never one row; the longest rule found wins. Pages are judged as distinct (host, path)
pairs, and meet the result again at the end.

Everything is DataFrame functions. The sweep sees every host once however many pages it has, and
hosts are spread over range partitions by key, whatever their domain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardflow.llm.common import only, written

#: The rules of the registered query (fixed values): verdict, host, path.
QUERY_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"),
               ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"),
               ("block", "net", "/fr/")]


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def _fold(text: Column) -> Column:
    """A-Z lower-cased and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` up to ``/``, ``?``, ``#``; path from there to ``?``, ``#``."""
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return _fold(host), path


def host_key(host: Column) -> Column:
    """Labels in reverse order, each ended by a slash; an empty host has the empty key.

    Keys order as UTF-8 bytes, and a slash cannot be inside a host, so the keys that begin with a
    rule's key are the rule's host and its subdomains.
    """
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "/"), F.lit("/")))


def _after(key: Column) -> Column:
    """The first key beyond all that begin with ``key``: 0 follows the slash that ends it."""
    return F.concat(F.substring(key, 1, F.length(key) - 1), F.lit("0"))


def segments(rules: DataFrame) -> DataFrame:
    """``(key, stack)``: from ``key`` to the next one the rule hosts in ``stack`` are active.

    Rules with the same host share an interval. The rule hosts above a host are its own suffixes,
    so a stack is put together by an equi-join on the suffixes of each boundary key; its depth is
    at most the number of labels. An interval opens at its key and closes at the key after it,
    where the stack of the enclosing host goes on.
    """
    # At most one entry per length, whatever the number of rules.
    per_host = rules.groupBy("key").agg(
        F.sort_array(F.collect_set(F.length("path"))).alias("lengths"))
    opens = rules.select("key", F.col("key").alias("owner")).distinct()
    parent = F.regexp_extract("key", r"(?s)^(.*/)?[^/]*/$", 1)
    closes = opens.select(_after(F.col("key")).alias("key"), parent.alias("owner"))
    # Where an interval opens just as another closes, the opening one says what is active.
    bounds = opens.withColumn("first", F.lit(0)).union(closes.withColumn("first", F.lit(1)))
    bounds = bounds.groupBy("key").agg(F.min_by("owner", "first").alias("owner"))
    labels = F.split(F.col("owner"), "/")
    above = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "/"), F.lit("/")))
    spread = bounds.select("key", F.explode(above).alias("host"))
    stacks = spread.join(per_host.withColumnRenamed("key", "host"), "host").groupBy("key").agg(
        F.collect_list(F.struct("host", "lengths")).alias("stack"))
    nothing = F.array().cast(stacks.schema["stack"].dataType)
    return bounds.select("key").join(stacks, "key", "left").select(
        "key", F.coalesce("stack", nothing).alias("stack"))


def sweep(keys: DataFrame, cuts: DataFrame) -> DataFrame:
    """``(key, stack)`` for every key of ``keys``: the stack of the last cut at or before it."""
    events = keys.select("key", F.lit(1).alias("kind"), F.lit(None).cast(
        cuts.schema["stack"].dataType).alias("stack")).union(
        cuts.select("key", F.lit(0).alias("kind"), "stack"))
    ranged = written(events.repartitionByRange("key", "kind").withColumn(
        "part", F.spark_partition_id()), "sweep")
    order = Window.partitionBy("part").orderBy("key", "kind")
    within = ranged.withColumn("seen", F.last("stack", ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # One row per range partition: what the partitions before it leave active.
    ends = ranged.where("kind = 0").groupBy("part").agg(F.max_by("stack", "key").alias("end"))
    parts = ranged.select("part").distinct().join(ends, "part", "left")
    carried = parts.select("part", F.last("end", ignorenulls=True).over(
        Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(
            Window.unboundedPreceding, -1)).alias("carried"))
    return within.where("kind = 1").join(carried, "part").select(
        "key", F.coalesce("seen", "carried").alias("stack"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages(page_id, url)``.

    ``rules(verdict, host, path)``: a rule fits its host and all its subdomains if the path of the
    url starts with the rule's. The longest fitting rule wins, measured by host and path together
    and then by host; of equal ones with both verdicts the one that blocks. ``rule`` is host and
    path of the winner, null where none fits and the verdict is ``default``.

    Null urls and those without ``://``: empty host and path, no rule. Null page_id: returned as
    such; repeated rows are returned each. Rules with a null part or an empty host are left out,
    repeated rules count once. Empty pages give an empty result, empty rules the default for all.
    Extra columns are ignored.
    """
    pages = only(pages, page_id="long", url="string")
    host, path = host_and_path(F.col("url"))
    pages = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn(
        "key", host_key(F.col("host")))
    rules = only(rules, verdict="string", host="string", path="string").where(
        "verdict IS NOT NULL AND path IS NOT NULL AND host <> ''")
    rules = rules.select("verdict", _fold(F.col("host")).alias("host"), "path").distinct()
    rules = rules.select("*", host_key(F.col("host")).alias("key"),
                         (F.length("host") + F.length("path")).alias("length"),
                         F.length("host").alias("host_length"))
    places = pages.select("key", "path").distinct()
    stacks = sweep(places.select("key").distinct(), written(segments(rules), "segments"))
    active = places.join(written(stacks.where("size(stack) > 0"), "stacks"), "key").select(
        "key", "path", F.explode("stack").alias("on"))
    cuts = active.select("key", "path", F.col("on.host").alias("rule_key"), F.explode(F.filter(
        "on.lengths", lambda n: n <= F.length("path"))).alias("n"))
    named = rules.withColumnsRenamed({"key": "rule_key", "path": "prefix"})
    # Structs order by length, then host length, then text; "block" sorts after "allow".
    best = F.max(F.struct("length", "host_length", "host", "prefix", "verdict")).alias("best")
    found = (cuts.select("key", "path", "rule_key",
                         F.substring("path", F.lit(1), F.col("n")).alias("prefix"))
             .join(named, ["rule_key", "prefix"]).groupBy("key", "path").agg(best))
    return pages.join(written(found, "found"), ["key", "path"], "left").select(
        "page_id", "host", "path",
        F.concat(F.col("best.host"), F.col("best.prefix")).alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


URL_ORACLE = r"""
WITH cut AS (
    SELECT page_id, CASE WHEN contains(url, '://')
        THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), split AS (
    SELECT page_id, coalesce(rest, '') AS rest,
        regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1, 's') AS raw_host,
        regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1, 's') AS path
    FROM cut
), page AS (
    SELECT page_id, path, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS host
    FROM split
), rule AS (
    SELECT * FROM (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
        ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'),
        ('block', 'net', '/fr/')) AS r(verdict, rule_host, rule_path)
), fit AS (
    SELECT p.page_id, p.host, p.path, r.verdict, r.rule_host || r.rule_path AS rule,
        row_number() OVER (PARTITION BY p.page_id
            ORDER BY length(r.rule_host || r.rule_path) DESC) AS place
    FROM page p LEFT JOIN rule r ON (p.host = r.rule_host OR p.host LIKE '%.' || r.rule_host)
        AND starts_with(p.path, r.rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fit WHERE place = 1
"""
