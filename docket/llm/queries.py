"""The queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docket.llm import (chat, embedding_dedup, exact_dedup, lm_scoring, merkle, minhash_dedup, mixing, packing, quality, repair, secrets,
                        toxicity, urls)
from docket.llm.common import held_out, load


def learn_from() -> Column:
    """The ids of ``labels`` that classifiers may learn from."""
    return ~held_out(F.col("doc_id"), 4, 2)


def op1_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(load(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op2_url_language_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(load(spark, sf_dir, "pages", "page_id", "url"))


def op3_hashed_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    back = held_out(F.col("doc_id"), 10, 0)
    return lm_scoring.score_texts(docs, ~back).select(
        "doc_id", back.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit(docs, load(spark, sf_dir, "labels", "doc_id", "toxic"), learn_from())
    return toxicity.with_score(docs, model).select(
        F.col("id").alias("doc_id"), held_out(F.col("id"), 4, 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_soft_membership_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    out, names = mixing.mix(docs, load(spark, sf_dir, "labels", "doc_id", "quality"), with_rows=False)
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_words"),
                      *[F.col("p")[k].alias(f"p_{x}") for k, x in enumerate(names)], "rate", "copies")


def op6_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    model = quality.fit(docs, load(spark, sf_dir, "labels", "doc_id", "quality"), learn_from())
    return quality.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(load(spark, sf_dir, "documents", "doc_id", "text"))


def op8_bayesian_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_groups(load(spark, sf_dir, "documents", "doc_id", "text"))


def op9_concatenate_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents", "doc_id", "text"))


def op10_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan_secrets(load(spark, sf_dir, "documents", "doc_id", "text")))


def op11_slot_pivot_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(load(spark, sf_dir, "documents"))


def op12_token_level_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.with_control_text(load(spark, sf_dir, "conversations"))
    return chat.read_back(chat.format_chats(rows)).drop("n_tokens")


def op13_four_russians_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return repair.digest(repair.repair(repair.damage(rows)), rows)


QUERIES = {f.__name__: f for f in (
    op1_cross_polytope, op2_url_language_models, op3_hashed_maxent, op4_kneser_ney_toxicity, op5_soft_membership_mixing,
    op6_attention_quality, op7_chunk_recipes, op8_bayesian_minhash, op9_concatenate_and_cut, op10_trigram_secrets,
    op11_slot_pivot_merkle, op12_token_level_chat, op13_four_russians_repair)}
ORACLES = {"op1_cross_polytope": embedding_dedup.ORACLE_SQL, "op7_chunk_recipes": exact_dedup.ORACLE_SQL,
           "op8_bayesian_minhash": minhash_dedup.ORACLE_SQL, "op11_slot_pivot_merkle": merkle.ORACLE_SQL,
           "op12_token_level_chat": chat.ORACLE_SQL, "op13_four_russians_repair": repair.ORACLE_SQL}
