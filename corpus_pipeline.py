"""A corpus pipeline over `documents`: each stage works on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sumweave.llm import byte_bpe, decontaminate, ngram_join, substring_dedup, toxicity
from sumweave.llm.registry import table
from sumweave.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents not called toxic. The model is trained on labelled documents of those given."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are similar, directly or over others, the one with the least id; repeated rows of it count once.
    Documents without an id stay, and so does every different text of an id that is the least of its group."""
    heads = ngram_join.similar_documents(spark, docs).where("doc_id = component_id").select("doc_id").distinct()
    alone = docs.where("doc_id is null")
    kept = docs.join(heads, "doc_id", "left_semi").select(*docs.columns, F.sha2("text", 256).alias("_text"))
    return kept.dropDuplicates(["doc_id", "_text"]).drop("_text").union(alone)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without their repeated passages, n_chars counted anew; one that is nothing but repeats has an empty text."""
    cleaned = substring_dedup.remove_repeats(spark, docs)
    return cleaned.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def reject_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without benchmark contamination."""
    return decontaminate.keep_clean(spark, docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents: doc_id, n_tokens, ids (packed little-endian unsigned 32-bit integers), and whether they decode to the text."""
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return byte_bpe.checked(docs, ranks, pattern)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("ngram_join", one_of_each_group),
    ("substring_dedup", cut_repeats),
    ("decontaminate", reject_contaminated),
    ("byte_bpe", tokenize),
]

#: SQL can't express the trained classifier or the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to `documents`; each result is written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
