"""A training corpus from raw documents, in stages that are each written before the next one reads.

Every stage but the last returns the columns of ``documents``, with ``n_chars`` kept equal to the text's length; null text stays
null where a stage leaves a document alone. Empty tables pass through every stage; columns that share names with the operators' own
stay as they are.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import decontaminate, jaccard, line_dedup, packing, quality
from cairn.llm.names import free_names
from cairn.llm.store import shared_root


def recounted(docs: DataFrame, like: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*like.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject, unchanged.

    Null and empty texts are scored like others; rows that repeat a ``doc_id`` or have none are judged by their own text.
    """
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), held_out_fold=None)
    score, = free_names(docs, "_score")
    return quality.score_quality(docs, model, score).where(F.col(score) >= quality.THRESHOLD).select(*docs.columns)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines of many documents stay in one of them.

    Null text becomes one empty line; rows that repeat a ``doc_id`` are one document, without a ``doc_id`` nothing is dropped.
    """
    return recounted(line_dedup.drop_lines(docs, counts=tuple(free_names(docs, "n_lines", "n_dropped"))), docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, unchanged.

    Rows are judged one by one, so one of several equal rows stays; rows without words or ``doc_id`` all stay.
    """
    return jaccard.drop_near(docs).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items are cut out; documents that are mostly such passages go.

    Null text holds none; rows that repeat a ``doc_id`` are judged one by one; items that are null or wordless hit nothing.
    """
    return recounted(decontaminate.remove_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences.

    Null text is the end token alone; every row is packed, also one that repeats a ``doc_id`` or has none.
    """
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", fresh_lines),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("best-fit packing", packed),
]

#: the fitted classifier and the tokenizer cannot be written in SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
