"""The corpus queries by name: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careerlake.llm import centroids, hard_negatives, mixing, url_filter
from careerlake.llm.common import held_out, read


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from careerlake.llm.token_counts import token_counts

    return token_counts(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), limit=512)


def op1_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from careerlake.llm.brown import class_model_scores

    scored = class_model_scores(read(spark, sf_dir, "documents"), ~held_out(7, 2))
    return scored.withColumn("held_out", held_out(7, 2)).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from careerlake.llm.simhash import near_duplicates

    return near_duplicates(read(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from careerlake.llm.quality import quality_scores

    scored = quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), ~held_out(4, 2), threshold=0.7)
    return scored.select("doc_id", held_out(4, 2).alias("held_out"), "score", "predicted")


def op5_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    from careerlake.llm.merge_dropout import segmentations

    return segmentations(read(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), rate=0.1, seed=5).drop("ids")


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from careerlake.llm.ann import nearest

    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from careerlake.llm.html_extract import main_texts

    return main_texts(read(spark, sf_dir, "pages"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_report(read(spark, sf_dir, "documents"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from careerlake.llm.embedding_dedup import near_duplicate_vectors

    return near_duplicate_vectors(read(spark, sf_dir, "embeddings"), threshold=0.98)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from careerlake.llm.toxicity import fit, toxicity_scores

    docs = read(spark, sf_dir, "documents")
    scored = toxicity_scores(docs, fit(docs, read(spark, sf_dir, "labels"), ~held_out(3, 1)), threshold=0.7)
    return scored.select("doc_id", held_out(3, 1).alias("held_out"), "score", "predicted")


def op11_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(read(spark, sf_dir, "embeddings"), k=40, rounds=5, dim=64, scale=256, salt="2")


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_filter.RULES, "verdict string, host string, path string")
    return url_filter.judge(read(spark, sf_dir, "pages"), rules)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0, positives=5, negatives=5, least=80, most=100, scale=256)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_brown_lm": op1_brown_lm,
    "op2_simhash": op2_simhash,
    "op3_quality": op3_quality,
    "op4_token_counts": op4_token_counts,
    "op5_merge_dropout": op5_merge_dropout,
    "op6_ann": op6_ann,
    "op7_html": op7_html,
    "op8_mixing": op8_mixing,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_clusters": op11_clusters,
    "op12_url_filter": op12_url_filter,
    "op13_hard_negatives": op13_hard_negatives,
}

#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op8_mixing": mixing.oracle_sql(),
    "op11_clusters": centroids.oracle_sql(),
    "op12_url_filter": url_filter.oracle_sql(),
    "op13_hard_negatives": hard_negatives.oracle_sql(),
}
