"""The registered queries of this package: thin views over the operators, one per operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.bpe_codec import BpeParams, encode_documents
from wardflow.llm.common import table
from wardflow.llm.decontamination import find_leaks
from wardflow.llm.importance_resampling import resample
from wardflow.llm.jaccard_join import join_sets
from wardflow.llm.merkle_manifest import prove
from wardflow.llm.minhash_dedup import NearDupParams, near_duplicates
from wardflow.llm.perplexity_rules import judge_quality
from wardflow.llm.pii_supervision import find_pii
from wardflow.llm.secret_scan import find_secrets
from wardflow.llm.sql_oracles import RESAMPLING_SQL, jaccard_sql, merkle_sql
from wardflow.llm.token_counts import TokenCountParams, count_tokens
from wardflow.llm.toxic_neighbours import score_toxicity
from wardflow.llm.url_rules import QUERY_RULES, URL_ORACLE, judge_urls, rules_table
from wardflow.llm.warc_index import WARC_ORACLE, read_back

VOCABULARY = "byte_bpe_50k.json"


def op1_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document, encoded and decoded."""
    return encode_documents(table(spark, sf_dir, "documents"),
                            BpeParams(public_tokenizers.path(VOCABULARY)))


def op2_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, perplexity with its band, and the verdict of every document."""
    return judge_quality(table(spark, sf_dir, "documents"))


def op3_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's capture, written to archives and read back by their index."""
    return read_back(table(spark, sf_dir, "pages")).drop("html")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, as spans."""
    return find_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")


def op5_toxic_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by its nearest labelled examples."""
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_pii_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, as spans."""
    found = find_pii(table(spark, sf_dir, "documents"))
    return found.withColumn("n_spans", F.size("found").cast("long")).drop("found")


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    return judge_urls(table(spark, sf_dir, "pages"), rules_table(spark, QUERY_RULES))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it holds."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document."""
    return count_tokens(table(spark, sf_dir, "documents"),
                        TokenCountParams(public_tokenizers.path(VOCABULARY)))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents at Jaccard 0.8 or more over two-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), NearDupParams(shingle=2))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, roots and proof, checked against the manifest's root."""
    return prove(table(spark, sf_dir, "documents"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents at Jaccard 0.9 or more over three-word shingles."""
    return join_sets(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight towards the benchmark's words, and the tenth that is drawn."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query for query in (
        op1_bpe_codec, op2_perplexity_rules, op3_warc_index, op4_secret_scan,
        op5_toxic_neighbours, op6_pii_supervision, op7_url_rules, op8_decontamination,
        op9_token_counts, op10_minhash_near_dedup, op11_merkle_manifest, op12_jaccard_join,
        op13_importance_resampling)
}
LLM_ORACLES: dict[str, str] = {
    "op3_warc_index": WARC_ORACLE,
    "op7_url_rules": URL_ORACLE,
    "op10_minhash_near_dedup": jaccard_sql(2, 80, ", coalesce(component, doc_id) = doc_id AS kept"),
    "op11_merkle_manifest": merkle_sql(),
    "op12_jaccard_join": jaccard_sql(3, 90),
    "op13_importance_resampling": RESAMPLING_SQL,
}
