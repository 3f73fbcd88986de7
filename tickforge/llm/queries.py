"""The training-data queries: thin digests of what the operators return."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm import decontamination, jaccard_join, language_id, lm_scoring, packing, substring_dedup, suffix_dedup, topk_search, toxicity, url_filter
from tickforge.llm.scratch import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(spark, table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).select("doc_id", "held_out", "lang_pred", "score")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.code(spark, table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(spark, spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "host", "path", "rule", "verdict")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.score(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    out = decontamination.exact_matches(spark, docs.select("doc_id", "text"), benchmark)
    ids = F.array_join(F.array_sort(F.transform("item_ids", lambda i: i.cast("string"))), ",")
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(ids.cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_shared")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.with_crc(packing.pack(spark, table(spark, sf_dir, "documents"), tokenizer_path()))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return topk_search.search(spark, docs, docs.where("doc_id % 100 = 0"), k=10)


QUERIES = {f.__name__: f for f in (op1_language_id, op2_lm_scoring, op3_url_filter, op4_substring_dedup, op5_toxicity, op6_benchmark_decontamination, op7_suffix_array_dedup, op8_packing, op9_ngram_jaccard_join, op10_topk_search)}
