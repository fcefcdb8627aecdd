"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.llm import (
    chunked_bpe,
    decontaminate,
    exact_dedup,
    jaccard_join,
    kd_sharding,
    lexical_search,
    line_quality,
    lm_scoring,
    quality,
    substring_dedup,
    token_alignment,
    token_files,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    _REGISTRY[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """A public tokenizer's file; ``TOKENIZER_FOLDER`` may name another folder."""
    folder = os.environ.get("TOKENIZER_FOLDER")
    if not folder:
        folder = os.path.dirname(find_spec("public_tokenizers").origin)
    return os.path.join(folder, name)


@query
def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = tokenizer_file("byte_bpe_50k.json")
    out = token_files.new_folder(spark, "token-ids")
    token_files.write_token_files(table(spark, folder, "documents"), out, tokenizer)
    index = token_files.read_index(spark, out)
    return token_files.read_token_files(index, out, tokenizer, with_ids=False)


@query
def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    join = jaccard_join.Join(words=3, percent=90)
    found = jaccard_join.near_components(table(spark, folder, "documents"), join)
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.n_hit().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


@query
def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents"), keep=exact_dedup.LARGEST)


@query
def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, folder, "documents"))


@query
def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op7_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score_corpus(table(spark, folder, "documents"))


@query
def op8_kd_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = kd_sharding.kd_shards(kd_sharding.metadata(table(spark, folder, "documents")), shards=8)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    out = token_files.new_folder(spark, "warc")
    warc.write_warc(table(spark, folder, "pages"), out)
    records = warc.read_warc(spark.read.parquet(f"{out}/index"), with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op10_chunked_bpe(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return chunked_bpe.digests(
        chunked_bpe.encode_decode(documents, tokenizer_file("word_bpe_49k.json"))
    )


@query
def op11_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    return line_quality.line_quality(table(spark, folder, "documents"))


@query
def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.align(
        table(spark, folder, "documents"),
        tokenizer_file("byte_bpe_50k.json"),
        tokenizer_file("piece_bpe_32k.model"),
    )
