"""The queries of the corpus operators, one for each, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, html_extract, imatch, lm_score, mix, ngram_join, quality, shard, token_count, toxicity
from .common import table

TOKENIZER = "piece_bpe_32k.model"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.shard(table(spark, sf_dir, "documents"), shards=16)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix(table(spark, sf_dir, "documents"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"), width=4, percent=85).select("doc_id", "n_shingles", "component_id", "n_linked")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, vecs = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.score(vecs, model).select("doc_id", "held_out", "score", "predicted", F.array_join("evidence", ",").alias("evidence"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), tokenizer_path(), limit=4096)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


QUERIES = {f.__name__: f for f in (op1_lm_scoring, op2_fingerprints, op3_sharding, op4_decontamination, op5_mixing, op6_ngram_join, op7_html_extraction, op8_toxicity, op9_token_counts, op10_quality)}
ORACLE: dict[str, str] = {"op5_mixing": mix.ORACLE_SQL}
