"""Queries over the driver's tables, one per operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from plinth.llm import common, edit_embedding, langid, maxscore, mixing, packing, pii, quality, simhash_dedup, token_rollup, toxicity
from plinth.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.severity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")), ["doc_id"])


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), pii.session_key(spark))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = maxscore.quantise(table(spark, sf_dir, "embeddings"))
    found = maxscore.top_k(vectors, vectors.where("id % 100 = 0"))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op5_edit_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns agreed on, and class_id of equal and near texts."""
    prints = common.materialize(edit_embedding.fingerprint_documents(table(spark, sf_dir, "documents")), "prints")
    return edit_embedding.with_classes(prints)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).withColumn("probability", F.round("probability", 6))


def op7_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are loaded under two tokenizer versions, revised from words to BPE counts, and retried; then a withdrawal of the
    word counts as they were loaded is undone. Totals come from the committed deltas."""
    counts = common.materialize(token_rollup.counted(table(spark, sf_dir, "documents")), "counts")
    rollup = token_rollup.Rollup(spark, common.new_path(spark, "rollup"))
    change = token_rollup.changes
    load = change(counts, "insert", token_rollup.WORDS, "words")
    rollup.commit("load-words", load)
    rollup.commit("load-draft", change(counts, "insert", token_rollup.BPE, "words"))
    rollup.commit("revise-draft", change(counts, "revise", token_rollup.BPE, "bpe", "words"))
    rollup.commit("load-words", load)  # a retry adds nothing
    rollup.commit("withdraw", change(counts, "delete", token_rollup.WORDS, "words"))
    rollup.compact()
    rollup.commit("restore", load)
    return rollup.totals()


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.materialize(packing.pieces(table(spark, sf_dir, "documents")), "pieces"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, ~langid.held_out(F.col("doc_id")))
    found = langid.identify(docs.select("doc_id", "text"), model, ["doc_id"])
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_pii, op3_simhash, op4_maxscore, op5_edit_embedding, op6_mixing, op7_token_rollup, op8_quality, op9_packing, op10_langid)}


def _op4_sql() -> str:
    return """
WITH q AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM q a JOIN q b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""


def _op6_sql() -> str:
    ctes, last = mixing.mixing_sql()
    return f"WITH {ctes}\nSELECT doc_id, k_source AS source, k_lang AS lang, k_topic AS topic, k_tokens AS tokens, round(probability, 6) AS probability, selected FROM {last}"


def oracle_sql() -> dict[str, str]:
    return {"op4_maxscore": _op4_sql(), "op6_mixing": _op6_sql()}
