"""Training-data pipeline over ``documents``: every stage works on all that the one before kept.

Quality rejects go first, then exact copies, then near copies (five-word shingles, similarity 0.8),
then benchmark passages; what is left is tokenized.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.llm import chunked_bpe, decontaminate, exact_dedup, jaccard_join, quality
from lakegate.llm.common import stage
from lakegate.llm.queries import table, tokenizer_file


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.drop_near_copies(docs, jaccard_join.Join(words=5, percent=80))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = chunked_bpe.encode_decode(docs, tokenizer_file("word_bpe_49k.json"))
    return encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality_classifier", good_quality),
    ("exact_dedup", without_copies),
    ("ngram_jaccard_join", without_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("bpe_encoding", token_ids),
]

#: SQL expresses neither the discriminant, the automaton's cuts nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
