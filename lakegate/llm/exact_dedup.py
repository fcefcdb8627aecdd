"""Exact duplicates by a 128-bit content hash, with the bytes compared inside each group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import pick, stage

SMALLEST, LARGEST = "smallest", "largest"


def exact_groups(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = SMALLEST
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are grouped by (MD5, bytes): the hash places them, the bytes decide, so a collision of
    the hash makes two groups. Copies meet in a partial aggregate first, hence a hot text reaches
    the shuffle once per task. The documents then join the groups by digests alone; that side has
    no text, and a hot group is split by adaptive execution.

    NULL counts as the empty text. Rows repeated with one id are copies like any others: they
    count in ``group_size`` and carry the same ``kept``. A group of NULL ids only has a NULL
    ``keep_id`` and is kept. Other columns are not read. An empty table gives an empty result.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    rows = rows.withColumn("content_hash", F.unhex(F.md5("text")))
    chosen = F.min("doc_id") if keep == SMALLEST else F.max("doc_id")
    groups = (
        rows.groupBy("content_hash", "text")
        .agg(chosen.alias("keep_id"), F.count("*").alias("group_size"))
        .select("content_hash", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    return (
        rows.select("doc_id", "content_hash", F.sha2("text", 256).alias("text_sha256"))
        .join(stage(groups, "exact-groups"), ["content_hash", "text_sha256"])
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            "text_sha256",
        )
    )


def drop_exact_copies(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = SMALLEST
) -> DataFrame:
    """The input with one whole row left of each group of equal texts, in one shuffle.

    Of rows that share the id that stays, the one with the smallest hash of all columns is taken.
    A NULL text is the empty text for grouping; the row that stays is returned as it was.
    """
    key = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    everything = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    order = F.struct(F.col(f"`{id_col}`").alias("a"), F.xxhash64(everything).alias("b"))
    best = (F.min_by if keep == SMALLEST else F.max_by)(everything, order)
    return (
        docs.groupBy(F.unhex(F.md5(key)).alias("__hash"), key.alias("__text"))
        .agg(best.alias("__row"))
        .select(*(F.col("__row").getField(c).alias(c) for c in docs.columns))
    )
