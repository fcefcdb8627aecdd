from __future__ import annotations

import time
from pathlib import Path

from pyspark.sql import functions as F

from lakegate.sources import staging


def _shuffle_files(spark) -> set[Path]:
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for folder in manager.localDirsString() for f in Path(folder).rglob("shuffle_*.data")}


def test_a_staged_frame_leaves_no_shuffle_files(spark):
    before, setting = _shuffle_files(spark), spark.conf.get(staging._CLEANUP, None)
    rows = spark.range(20_000).select((F.col("id") % 7919).alias("k"), "id")
    counts = rows.repartition(3, "k").groupBy("k").agg(F.count("*").alias("n"))
    staged = staging.stage(counts, "cleanup")
    for _ in range(50):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(staging._CLEANUP, None) == setting
    # Both frames stay readable.
    assert staged.count() == counts.count() == counts.count() == 7919
