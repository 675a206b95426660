"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

Every stage takes an empty table (and returns one), null and repeated ids, null and empty texts
and columns beyond those of ``documents``, which pass through all but the last stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.llm import decontaminate, jaccard_join, language_mix, line_dedup, packing
from yearloom.llm.queries import small_batches, tokenizer_file
from yearloom.session import scratch_dir


SEQUENCE_DOCUMENTS = 64
SEQUENCE_ATTENTION = 3 * packing.SEQUENCE_TOKENS ** 2 // 4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter (null and empty texts too) go, and texts of 20 words or more that the mixture of the labelled languages
    inferred for them (operator 1's) doesn't explain. Without any label all documents with a letter stay."""
    small_batches(spark)
    return language_mix.accepted(docs, F.lit(True))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 20 code points or more in three or more documents stay in that of the largest id; n_chars follows the text. Rows that share
    an id count as one document, those without an id are left as they are."""
    small_batches(spark)
    kept = line_dedup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the smallest id, one without an id only if all are. Rows that share an id
    are told apart by their texts; documents without words stay."""
    small_batches(spark)
    return jaccard_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go; items without text are skipped, those without an id are not."""
    small_batches(spark)
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences and offsets: at most 2048 tokens, 64 documents and three quarters of a full sequence's
    attention cost each (a longer piece is a sequence by itself). A null text is a piece of the separator alone."""
    small_batches(spark)
    return packing.pack_documents(docs, tokenizer_file(), documents=SEQUENCE_DOCUMENTS, attention=SEQUENCE_ATTENTION)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Language identification, gapped string matching and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; every stage works on what its predecessor wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{scratch_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
