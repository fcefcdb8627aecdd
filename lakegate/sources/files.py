"""File manifests: path, size, SHA-256 and row count of every source file."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakegate.functions import hashing
from lakegate.sources.staging import stage, stage_measured

#: Blocks (file ranges) known to every task are sent out below this size, else joined by shuffle.
_SEND_BYTES = 64 * 1024 * 1024


def file_listing(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Path and size of each file; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .load(paths)
        .select(F.col("path"), F.col("length").alias("file_bytes"))
    )


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The bytes between line feeds, with file, block and a number that rises inside a block.

    The text source cuts large files into blocks that different tasks read, on any file system
    Spark can read; it hands on the bytes as they are.
    """
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("value"),
        F.col("_metadata.file_path").alias("__path"),
        F.col("_metadata.file_size").alias("file_bytes"),
        F.concat(
            F.col("_metadata.file_path"), F.lit("@"), F.col("_metadata.file_block_start")
        ).alias("__block"),
        F.col("_metadata.file_block_start").alias("__start"),
        F.monotonically_increasing_id().alias("__number"),
    )


def file_hashes(
    spark: SparkSession, paths: list[str], *, send_bytes: int = _SEND_BYTES
) -> DataFrame:
    """Path, size and content hash of each file; one route for every size and file system.

    The hash is a tree over the lines of a file: SHA-256 of line number and bytes, added up inside
    the blocks of the file by the tasks that read them, then over the blocks, then hashed with the
    file's size. It depends on every byte and its place, but not on how the file is cut into
    blocks, and no task holds more than a line. Two reads: the first counts the lines of each
    block, so that the second knows how many come before a block. A file that changes between
    them, or is cut otherwise, stops the job.

    Files of zero bytes are not listed by the source; a feed file has at least its header. A file
    read as binary is one of long lines; a line must fit one value (2 GB).
    """
    counted = (
        _lines(spark, paths)
        .groupBy("__path", "__block", "__start")
        .agg(F.count(F.lit(1)).alias("__n"), F.min("__number").alias("__first"))
    )
    earlier = Window.partitionBy("__path").orderBy("__start").rowsBetween(
        Window.unboundedPreceding, -1
    )  # one row per block
    blocks, size = stage_measured(
        counted.select(
            F.col("__block").alias("__of_block"),
            "__n",
            "__first",
            F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
        ),
        "file-blocks",
    )
    if size <= send_bytes:
        blocks = F.broadcast(blocks)
    placed = _lines(spark, paths).join(blocks, F.col("__block") == F.col("__of_block"), "left")
    inside = F.col("__number") - F.col("__first")
    number = F.when((inside >= 0) & (inside < F.col("__n")), F.col("__before") + inside)
    checked = F.coalesce(
        number, F.raise_error(F.lit("a source file changed, or was cut otherwise, between two reads"))
    )
    digest = F.sha2(F.concat(checked.cast("string"), F.lit(":"), F.col("value")), 256)
    added = hashing.multiset_digest(placed, digest, ["__path", "file_bytes"])
    tree = F.sha2(F.concat_ws(":", F.col("file_bytes").cast("string"), "fingerprint_sha256"), 256)
    return stage(
        added.select(plain_path(F.col("__path")).alias("path"), "file_bytes", tree.alias("file_sha256")),
        "file-hashes",
    )


def plain_path(file_path: Column) -> Column:
    """A file's path as it was given: ``_metadata.file_path`` is percent-encoded."""
    return F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows of a file-based frame by source file (partial counts, one row per file and task)."""
    return df.groupBy(plain_path(F.col("_metadata.file_path")).alias("__file")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def relative_to(path: Column, root: str) -> Column:
    """Path below ``root``; paths elsewhere stay whole (and are refused on replay)."""
    plain = F.regexp_replace(path, "^file:/+", "/")
    base = root.removeprefix("file://").rstrip("/") + "/"
    return F.when(
        plain.startswith(base), F.substring(plain, F.lit(len(base) + 1), F.length(plain))
    ).otherwise(plain)


def file_manifest(
    spark: SparkSession, feeds: Mapping[str, DataFrame], paths: Mapping[str, list[str]], root: str
) -> DataFrame:
    """One row per file of every feed. A file without data rows counts 0."""
    counted = reduce(
        DataFrame.unionAll,
        [rows_per_file(df).withColumn("__dataset", F.lit(name)) for name, df in feeds.items()],
    )
    listed = reduce(
        DataFrame.unionAll,
        [
            file_listing(spark, paths[name]).select("path", F.lit(name).alias("dataset_name"))
            for name in feeds
        ],
    )
    hashed = listed.join(
        file_hashes(spark, [path for name in feeds for path in paths[name]]), "path"
    )
    same_file = (F.col("path") == F.col("__file")) & (F.col("dataset_name") == F.col("__dataset"))
    return hashed.join(counted, same_file, "left").select(
        "dataset_name",
        relative_to(F.col("path"), root).alias("source_file"),
        "file_sha256",
        "file_bytes",
        F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
    )


def dataset_manifest(parts: DataFrame) -> DataFrame:
    """One row per dataset. A dataset in one file keeps that file's name and hash; for many
    files the hash covers the bag of (path, hash) pairs and adds up in partial aggregates."""
    digest = F.sha2(F.concat_ws(":", "source_file", "file_sha256"), 256)
    bags = hashing.multiset_digest(parts, digest, ["dataset_name"]).select(
        F.col("dataset_name").alias("__dataset"), F.col("fingerprint_sha256").alias("__bag")
    )
    totals = parts.groupBy("dataset_name").agg(
        F.count(F.lit(1)).alias("__files"),
        F.min("source_file").alias("__first"),
        F.min("file_sha256").alias("__sha"),
        F.sum("file_bytes").alias("file_bytes"),
        F.sum("row_count").alias("row_count"),
    )
    single = F.col("__files") == 1
    many = F.concat(F.regexp_replace("__first", "[^/]*$", ""), F.lit("*"))
    return totals.join(bags, F.col("dataset_name") == F.col("__dataset")).select(
        "dataset_name",
        F.when(single, F.col("__first")).otherwise(many).alias("source_file"),
        F.when(single, F.col("__sha")).otherwise(F.col("__bag")).alias("file_sha256"),
        "file_bytes",
        "row_count",
    )
