"""Relation fingerprints and the hash of a whole output set."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.functions import hashing


def relation_fingerprint(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """One row; equal exactly when two relations hold the same bag of business rows."""
    digest = hashing.multiset_digest(df, hashing.row_digest(df, columns))
    return digest.select(F.lit(name).alias("relation_name"), "row_count", "fingerprint_sha256")


def relation_fingerprints(
    relations: Mapping[str, DataFrame], specs: Mapping[str, Sequence[str]]
) -> DataFrame:
    parts = [
        relation_fingerprint(relations[name], name, columns) for name, columns in specs.items()
    ]
    return reduce(DataFrame.unionAll, parts)


# --- kept per day ----------------------------------------------------------------------


def day_sums(df: DataFrame, name: str, columns: Sequence[str], day: str | None) -> DataFrame:
    """What a relation's fingerprint is made of, per day of the column ``day``.

    One row per day: ``relation_name``, ``partition_key`` (ISO date; empty for rows without one,
    and for a relation without days), ``row_count`` and the sums. All days together give
    :func:`relation_fingerprint`, so a day that did not change need not be read again.
    """
    key = F.lit("") if day is None else F.coalesce(F.col(day).cast("date").cast("string"), F.lit(""))
    rows = df.select(
        key.alias("partition_key"), hashing.row_digest(df, columns).alias("__row_digest")
    )
    sums = hashing.multiset_sums(rows, F.col("__row_digest"), ["partition_key"])
    return sums.select(F.lit(name).alias("relation_name"), *sums.columns)


def relation_day_sums(
    relations: Mapping[str, DataFrame],
    specs: Mapping[str, Sequence[str]],
    days: Mapping[str, str | None],
) -> DataFrame:
    parts = [
        day_sums(relations[name], name, columns, days[name]) for name, columns in specs.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def from_day_sums(sums: DataFrame, names: Sequence[str]) -> DataFrame:
    """The relations' fingerprints from their days; one row per name, also without any day."""
    listed = sums.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(name) for name in names])).alias("relation_name")
    )
    joined = F.broadcast(listed).join(sums, "relation_name", "left")
    return hashing.united(joined, ["relation_name"]).select(
        "relation_name", "row_count", hashing.sums_digest().alias("fingerprint_sha256")
    )


def refreshed(stored: DataFrame, relation: DataFrame, name: str, columns: Sequence[str], day: str, days: Sequence[str]) -> DataFrame:
    """Stored day sums with those of ``days`` (ISO dates) taken anew.

    The relation is filtered by these days before it is read, so where it is stored by ``day`` the
    files of all other days stay closed.
    """
    kept = stored.where((F.col("relation_name") != name) | ~F.col("partition_key").isin(list(days)))
    changed = relation.where(F.col(day).isin([date.fromisoformat(d) for d in days]))
    return kept.unionByName(day_sums(changed, name, columns, day))


def compare_days(source: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """Day by day: do two builds hold the same rows?"""
    keys = ("relation_name", "partition_key")
    digest = hashing.sums_digest()
    one = source.select(*keys, F.col("row_count").alias("source_rows"), digest.alias("__source"))
    two = rebuilt.select(*keys, F.col("row_count").alias("rebuilt_rows"), digest.alias("__rebuilt"))
    return one.join(two, list(keys), "full_outer").select(
        *keys, "source_rows", "rebuilt_rows", F.col("__source").eqNullSafe(F.col("__rebuilt")).alias("equivalent")
    )


# --- comparison of builds --------------------------------------------------------------


def output_set_hash(fingerprints: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Hash of the sorted ``name:rows:sha`` lines; one short line per fingerprinted relation."""
    line = F.concat_ws(
        ":", "relation_name", F.col("row_count").cast("string"), "fingerprint_sha256"
    )
    entry = F.struct(F.col("relation_name"), line.alias("line"))
    lines = F.transform(F.array_sort(F.collect_list(entry)), lambda item: item["line"])
    return fingerprints.groupBy(*by).agg(
        F.sha2(F.array_join(lines, "\n"), 256).alias("output_set_sha256")
    )


def compare_fingerprints(source: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """Relation by relation: do two builds hold the same rows?"""
    other = rebuilt.select(
        F.col("relation_name").alias("__name"),
        F.col("row_count").alias("__rows"),
        F.col("fingerprint_sha256").alias("rebuilt_sha256"),
    )
    same = F.col("fingerprint_sha256").eqNullSafe(F.col("rebuilt_sha256")) & F.col(
        "row_count"
    ).eqNullSafe(F.col("__rows"))
    return source.join(other, F.col("relation_name") == F.col("__name"), "full_outer").select(
        F.coalesce("relation_name", "__name").alias("relation_name"),
        F.coalesce("row_count", "__rows").alias("row_count"),
        F.col("fingerprint_sha256").alias("source_sha256"),
        "rebuilt_sha256",
        same.alias("equivalent"),
    )
