"""The stages of the corpus pipeline: ``(spark, docs, sf_dir) -> DataFrame``.

All but the last return the columns of the documents they are given. A decision is about a row,
not about a doc_id: each stage names its rows by the file they are in and their place in it, and
the operator judges under that name. So rows that share a doc_id are judged each by its own text,
rows without one are judged like all others, and of rows equal in every column that are copies of
each other one stays. An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.bpe_codec import BpeParams, encode_documents
from wardflow.llm.common import table, written
from wardflow.llm.decontamination import find_leaks
from wardflow.llm.minhash_dedup import NearDupParams, near_duplicates
from wardflow.llm.perplexity_rules import judge_quality, row_place
from wardflow.llm.secret_scan import mask_secrets

VOCABULARY = "byte_bpe_50k.json"


def _named(docs: DataFrame, at: Column | None = None) -> tuple[DataFrame, str]:
    """``docs`` with a 64-bit name of each row, and the name of that column.

    ``at`` is a further column to add, under that name followed by ``at``.

    File and row number are the same however often and by whatever tasks a table is read. What is
    no plain table is written as one first.
    """
    row = "_row"
    while row in docs.columns or row + "at" in docs.columns:
        row += "_"
    added = [F.xxhash64("_metadata.file_path", "_metadata.row_index").alias(row)]
    if at is not None:
        added.append(at.alias(row + "at"))
    try:
        return docs.select("*", *added), row
    except AnalysisException:
        return written(docs, "rows").select("*", *added), row


def _as_id(named: DataFrame, row: str) -> DataFrame:
    return named.withColumn("doc_id", F.col(row)).drop(row)


def _without(named: DataFrame, row: str, gone: DataFrame) -> DataFrame:
    gone = written(gone.select(F.col("doc_id").alias(row)).distinct(), "gone", True)
    return named.join(gone, row, "left_anti").drop(row).select(
        *[c for c in named.columns if c != row])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or leave their language's perplexity band go.

    So do null and empty texts, which have no words.
    """
    named, row = _named(docs, row_place())
    at = row + "at"
    verdicts = judge_quality(_as_id(named, row), at=at)
    return _without(named.drop(at), row, verdicts.where("NOT kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies stays: the one with the smallest doc_id.

    Rows with an id come before rows without; among equals one row stays. Null and empty texts
    are no copies of each other and stay.
    """
    named, row = _named(docs)
    judged = near_duplicates(_as_id(named, row), NearDupParams()).select(
        F.col("doc_id").alias("row"), "component_id")
    ids = named.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    members = written(judged.join(ids, "row"), "members", True)
    order = F.struct(F.col("doc_id").isNull().alias("keyless"), "doc_id", "row")
    stays = written(members.groupBy("component_id").agg(
        F.min(order)["row"].alias("stays"), F.count("row").alias("n")).where("n > 1")
        .select("component_id", "stays"), "stays", True)
    gone = members.join(stays, "component_id").where("row <> stays")
    return _without(named, row, gone.select(F.col("row").alias("doc_id")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go; null and empty texts hold none."""
    named, row = _named(docs)
    return _without(named, row, find_leaks(_as_id(named, row), table(spark, sf_dir, "benchmark")))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by its kind in brackets; n_chars follows the new text."""
    return mask_secrets(docs)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, their number, and the digests of ids and decoded text."""
    return encode_documents(docs, BpeParams(public_tokenizers.path(VOCABULARY), with_ids=True))
