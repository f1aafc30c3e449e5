"""The queries of this subpackage by name, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from soundings.llm import (
    conversations,
    credentials,
    exact_dedup,
    graph_dedup,
    licenses,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    periodic_runs,
    quality,
    quality_rules,
    toxicity,
)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: spark.read.parquet(f"{sf_dir}/{name}.parquet")


_documents, _labels, _embeddings, _conversations = map(
    _table, ("documents", "labels", "embeddings", "conversations")
)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.similar_lines(_documents(spark, sf_dir))
    return found.select(
        "doc_id",
        "n_lines",
        F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.transform("removed", lambda at: at.cast("string")), ",").alias("removed"),
    )


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_links(_documents(spark, sf_dir)).drop("text_key")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.scan_secrets(_documents(spark, sf_dir))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_words(_documents(spark, sf_dir))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_documents(spark, sf_dir), _labels(spark, sf_dir))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(_documents(spark, sf_dir), _labels(spark, sf_dir))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_documents(spark, sf_dir))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_documents(spark, sf_dir))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_dedup.embedding_links(_embeddings(spark, sf_dir))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), default_tokenizer())


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_damaged(_conversations(spark, sf_dir))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge_quality(_documents(spark, sf_dir))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return judged.select("doc_id", *base, "kept", "quality", "votes")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = periodic_runs.with_repeated_tails(_documents(spark, sf_dir))
    return periodic_runs.run_digest(periodic_runs.periodic_runs(damaged))


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_ngram_jaccard_join,
        op3_secret_scan,
        op4_source_mixing,
        op5_toxicity,
        op6_quality,
        op7_license_scan,
        op8_exact_dedup,
        op9_embedding_dedup,
        op10_packing,
        op11_conversation_repair,
        op12_quality_rules,
        op13_periodic_runs,
    )
}

ORACLE_SQL = {
    "op8_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY text) AS keep_id,
               count(*) OVER (PARTITION BY text) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY text) AS kept,
               sha256(text) AS text_sha256
        FROM t
    """,
    "op9_embedding_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.e, b.e) >= 0.9
        ), reach AS (
            SELECT vec_id AS a, vec_id AS b FROM v
            UNION
            SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
        ), component AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
        counts AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id,
               vec_id = component_id AS kept
        FROM component LEFT JOIN counts USING (vec_id)
    """,
}
