"""The registered queries of the numbered operators, each over its whole table, and their oracles."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from ..sources.scratch import shared_folder
from . import ann, collocations, html_text, mixing, packing, token_store, toxicity, url_filters
from .alignment import Tokenizers, corpus_alignment
from .ngram_join import similar_documents
from .pii import KINDS, find_pii
from .repetition import repetition
from .session import bounded_batches
from .simhash import near_duplicates

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", html_text.extract(F.col("html")).alias("text"))
    return pages.withColumn("n_chars", F.char_length("text").cast("bigint"))


def pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``base_sha256`` and the counts are those of the plain identifiers, ``spans`` has all."""

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    found = _table(spark, sf_dir, "documents").select("doc_id", find_pii(F.col("text")).alias("found"))
    def number_of(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["base"] & (s["kind"] == kind))).cast("bigint").alias(f"n_{kind}")

    plain = F.filter("found", lambda s: s["base"])
    return found.select(
        "doc_id", *map(number_of, KINDS), F.sha2(listed(plain), 256).alias("base_sha256"), listed(F.col("found")).alias("spans")
    )


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def similar_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(_table(spark, sf_dir, "documents"))


def _crc32(ids: Column) -> Column:
    return F.crc32(ids).cast("bigint").alias("ids_crc32")


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/tokens-{uuid4().hex}"
    documents = _table(spark, sf_dir, "documents")
    token_store.write_store(documents, folder, public_tokenizers.path(TOKENIZER))
    read = token_store.read_store(spark, folder)
    return read.select(F.col("key").alias("doc_id"), "start", "n_tokens", _crc32(F.col("ids")))


def packed_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = packing.Packing(public_tokenizers.path(TOKENIZER))
    pieces = packing.pack(_table(spark, sf_dir, "documents"), options)
    return pieces.select("doc_id", "piece", "start", "length", _crc32(F.col("ids")), "sequence_id", "offset")


def toxic_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, _table(spark, sf_dir, "labels"))
    return documents.select("doc_id", toxicity.severity(F.col("text"), model).alias("s")).select("doc_id", "s.*")


def repetition_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return documents.select("doc_id", repetition(F.col("text")).alias("m")).select("doc_id", "m.*")


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def aligned_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = Tokenizers(public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES))
    return corpus_alignment(_table(spark, sf_dir, "documents"), files)


def all_queries() -> dict[str, Query]:
    return {
        "op1_url_filters": url_verdicts,
        "op2_mixing": mixed_sources,
        "op3_html_text": page_texts,
        "op4_pii": pii_spans,
        "op5_nearest_vectors": nearest_vectors,
        "op6_token_store": token_files,
        "op7_packing": packed_pieces,
        "op8_ngram_join": similar_groups,
        "op9_toxicity": toxic_grades,
        "op10_repetition": repetition_verdicts,
        "op11_collocations": phrases,
        "op12_simhash": simhash_groups,
        "op13_alignment": aligned_tokens,
    }


def all_oracles() -> dict[str, str]:
    return {"op1_url_filters": url_filters.oracle(), "op2_mixing": mixing.oracle(), "op11_collocations": collocations.oracle()}
