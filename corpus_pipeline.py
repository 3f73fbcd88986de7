"""The corpus pipeline: language ID, near-duplicate removal, substring dedup,
benchmark decontamination and packing.

Each stage takes (spark, docs, sf_dir), works on every row that the stage
before kept, and returns a DataFrame; run() writes each as Parquet and reads it
again for the next.  All but the last return the columns of documents, whatever
else there is beside doc_id and text.  Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm import decontamination, jaccard_join, language_id, packing, scratch, substring_dedup
from tickforge.llm.queries import tokenizer_path

#: A prediction of a lower calibrated probability counts as no language.
MIN_LANGUAGE_SCORE = 0.5


def _columns(out: DataFrame, docs: DataFrame, changed: bool = False) -> DataFrame:
    """The columns of docs again; n_chars follows a changed text."""
    values = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if changed and "n_chars" in docs.columns:
        values["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[values.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is told; those without letters or below the score go.

    Null and empty texts go.  Rows without doc_id, and rows that repeat one, are
    judged each by its own text.  Very long texts are judged whole.
    """
    out = language_id.identify(spark, docs)
    return _columns(out.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_LANGUAGE_SCORE)), docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of near copies.

    Rows that repeat a doc_id are one document: all of them stay, or all go.
    Rows without doc_id, and texts without words, link with nothing and stay.
    """
    groups = jaccard_join.join(spark, docs.select("doc_id", "text"))
    copies = groups.where("component_id != doc_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated passages; documents that lose all their words go.

    The earliest occurrence stays: rows without doc_id count as one document
    before all others, and rows that repeat a doc_id lose the same words.
    Documents that had no words to begin with stay.  White space between words
    becomes one space in every document.
    """
    out = substring_dedup.remove_repeats(spark, docs)
    return _columns(out.where("n_removed = 0 or n_removed < n_words"), docs, changed=True)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a window of a benchmark item.

    An empty benchmark drops nothing.  Rows without doc_id, and rows that repeat
    one, are judged each by its own text.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    out = decontamination.exact_matches(spark, docs, benchmark)
    return _columns(out.where("n_hit = 0"), docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, by sequence; a document without text is its end alone."""
    return packing.with_crc(packing.pack(spark, docs, tokenizer_path()))


STAGES = [
    ("language_id", language_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("substring_dedup", substring_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Language ID and packing have no SQL form; tests/llm/test_pipeline.py compares run() with a brute-force version of all stages but language ID, whose operator has a slow version of its own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch.ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.settle(spark, stage(spark, docs, sf_dir), name)
    return docs
