"""Input manifests: set hash, totals and replay verification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.bindings import mobility as m


def input_set_hash(manifest: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Hash of the sorted compact JSON of a manifest; file paths do not take part.

    A manifest has one row per dataset, so the collected list is short.
    """
    entry = F.struct("dataset_name", "file_bytes", "file_sha256", "row_count")
    payload = F.to_json(F.array_sort(F.collect_list(entry)))
    return manifest.groupBy(*by).agg(F.sha2(payload, 256).alias("input_set_sha256"))


def manifest_totals(manifest: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    return manifest.groupBy(*by).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).cast("bigint").alias("source_rows"),
        F.coalesce(F.sum("file_bytes"), F.lit(0)).cast("bigint").alias("source_bytes"),
    )


def escapes_root(path: Column) -> Column:
    """A recorded path that is absolute, has a scheme or climbs out with ``..`` parts."""
    parts = F.filter(F.split(path, "/"), lambda part: (part != "") & (part != "."))
    depth = F.aggregate(
        parts,
        F.struct(F.lit(0).alias("depth"), F.lit(0).alias("lowest")),
        lambda state, part: _step(state, part),
    )
    return path.startswith("/") | path.contains("://") | (depth["lowest"] < 0)


def _step(state: Column, part: Column) -> Column:
    depth = state["depth"] + F.when(part == "..", -1).otherwise(1)
    return F.struct(depth.alias("depth"), F.least(state["lowest"], depth).alias("lowest"))


def file_verdict(found_bytes: Column, found_sha256: Column) -> Column:
    """First reason a recorded file cannot be used again, or ``complete``."""
    return (
        F.when(escapes_root(F.col("source_file")), "escapes_root")
        .when(found_bytes.isNull(), "missing")
        .when(found_bytes != F.col("file_bytes"), "size_mismatch")
        .when(found_sha256 != F.col("file_sha256"), "sha_mismatch")
        .otherwise("complete")
    )


def verify_manifest(
    recorded: DataFrame, observed: DataFrame, keys: Sequence[str] = ("run_id", "dataset_name")
) -> DataFrame:
    """Compare recorded files with the files found now; found but never recorded files come
    out as ``unexpected``."""
    found = observed.select(
        *[F.col(name).alias(f"__{name}") for name in keys],
        F.col("file_bytes").alias("observed_bytes"),
        F.col("file_sha256").alias("observed_sha256"),
    )
    on = [F.col(name) == F.col(f"__{name}") for name in keys]
    joined = recorded.join(found, on, "full_outer")
    verdict = F.when(F.col("file_sha256").isNull(), "unexpected").otherwise(
        file_verdict(F.col("observed_bytes"), F.col("observed_sha256"))
    )
    rest = [name for name in ("dataset_name", "source_file") if name not in keys]
    return joined.select(
        *[F.coalesce(name, f"__{name}").alias(name) for name in keys],
        *rest,
        verdict.alias("verdict"),
    )


def replayable(
    verdicts: DataFrame,
    by: Sequence[str] = ("run_id",),
    datasets: Sequence[str] = m.DATASETS,
) -> DataFrame:
    """A run can be replayed when exactly the expected datasets are all complete."""
    expected = F.col("dataset_name").isin(list(datasets))
    good = F.count_if(expected & (F.col("verdict") == "complete"))
    total = F.count(F.lit(1))
    return verdicts.groupBy(*by).agg(
        total.alias("files"),
        good.alias("verified"),
        ((good == len(datasets)) & (total == len(datasets))).alias("replayable"),
    )


def replayable_runs(
    runs: DataFrame, verdicts: DataFrame, datasets: Sequence[str] = m.DATASETS
) -> DataFrame:
    """:func:`replayable` for every run; a run without any recorded file is not replayable."""
    return (
        runs.select("run_id")
        .join(replayable(verdicts, datasets=datasets), "run_id", "left")
        .select(
            "run_id",
            F.coalesce("files", F.lit(0)).alias("files"),
            F.coalesce("verified", F.lit(0)).alias("verified"),
            F.coalesce("replayable", F.lit(False)).alias("replayable"),
        )
    )


def missing_members(required: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Required names that are not present."""
    return required.select(key).distinct().join(present.select(key), key, "left_anti")
