"""Corpus pipeline: documents in, packed training sequences out.

Each stage reads what its predecessor kept, is written as Parquet to the shared folder, and is read again by the next:
quality rules drop documents, the n-gram Jaccard join keeps one document of each near-duplicate group, decontamination
drops documents that hold benchmark passages, the secret scan masks secrets, and packing cuts the tokens into sequences.
All stages but the last return the columns of ``documents``. ``ORACLE_SQL`` is None: the shared stages are not all
expressible in SQL (Markov models, tokenizer ids); tests/llm compares run() with a brute-force version instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegrad.llm import decontam, jaccard, packing, quality, secret_scan
from tablegrad.llm.common import prepare, table
from tablegrad.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality.keep_documents(docs, quality.POLICIES[quality.DEFAULT])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return secret_scan.redact(docs, secret_scan.train(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    pieces = packing.pack(docs)
    return pieces.select("sequence_id", "offset", "doc_id", "start", "length", "doc_tokens", F.crc32("ids").alias("ids_crc32"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the intermediate tables stay in the shared folder named by spark.checkpoint.dir."""
    docs = table(spark, sf_dir, "documents")
    base = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{base}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
