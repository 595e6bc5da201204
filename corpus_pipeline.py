"""Corpus preparation: quality, one document of each group of near copies, personal data, source weights, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. Between stages the rows are
written as Parquet in the shared folder and read again, so that no stage reaches back further than to its input.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailstrata.llm import mixing, packing
from retailstrata.llm.ngram_join import one_of_each_group
from retailstrata.llm.pii import mask_pii
from retailstrata.llm.repetition import kept_rows
from retailstrata.llm.session import bounded_batches
from retailstrata.sources.scratch import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOKENIZER = "byte_bpe_50k.json"
# Token ids and exact similarity have no SQL form that would be of use; the tests use brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    bounded_batches(spark)
    return kept_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id."""
    bounded_batches(spark)
    return one_of_each_group(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Identifiers are replaced by their kind."""
    bounded_batches(spark)
    return mask_pii(docs)


def source_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated so that each source's share goes with its size to the power 0.7, and shuffled."""
    return mixing.mix(docs).drop("copy")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 2048; see ``packing.pack`` for the columns. Copies of a document differ in ``row``."""
    bounded_batches(spark)
    pieces = packing.pack(docs, packing.Packing(public_tokenizers.path(TOKENIZER)))
    crc32 = F.crc32("ids").cast("bigint").alias("ids_crc32")
    return pieces.select("doc_id", "piece", "start", "length", crc32, "sequence_id", "offset", "row")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_weights", source_weights),
    ("packed", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/corpus-{uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
