"""From raw documents to packed training sequences, one operator after another.

Every stage reads all that its predecessor kept, and all but the last return
the columns of documents. Each stage's result is written, so a lost executor never repeats
an earlier stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillscope.llm.exact import without_exact_copies
from tillscope.llm.minhash import without_near_duplicates
from tillscope.llm.mixing import mixed_documents
from tillscope.llm.packing import pack_documents
from tillscope.llm.quality import good_documents, train
from tillscope.llm.staging import release, scratch_tables, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model finds good; it learns from the labels beside them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return good_documents(docs, train(docs, labels))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document of the largest doc_id stays."""
    return without_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates one document of the smallest doc_id stays."""
    return without_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all training sequences."""
    return pack_documents(docs).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("pack", pack),
]

# Trained models, hash bands and a tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result over ``documents``; other tables that were written are removed."""
    documents = docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before = docs
        with scratch_tables(spark) as kept:
            docs = staged(stage(spark, before, sf_dir), name)
            kept.append(docs)
        if before is not documents:
            release(before)
    return docs
