from __future__ import annotations

import re

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "orders", "lineitem", "events")


def test_every_query_is_registered_with_sql_or_reads_files():
    """Queries of the optional folders (``op…`` and ``pipeline``) have tests of their own."""
    own = {name for name in entry.queries() if not re.fullmatch(r"op\d+_.*|pipeline", name)}
    assert own - set(entry.oracle_sql()) == {"ingest_manifest", "readiness"}
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize(
    "name", ["trip_contract", "hourly_mobility", "run_deltas", "relation_fingerprints"]
)
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = entry.queries()[name](spark, FOLDER)
    order = sorted(df.columns)
    got = sorted(str(tuple(row[c] for c in order)) for row in df.collect())
    cursor = con.execute(entry.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    at = [names.index(column) for column in order]
    want = sorted(str(tuple(row[i] for i in at)) for row in cursor.fetchall())
    assert sorted(names) == order and got == want


def test_plans(spark):
    """Columns are pruned, and neither Python nor a cross product is in the flagship plan."""
    plan = entry.entry(spark)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "props" not in plan and "o_custkey" not in plan

    filtered = entry.queries()["previous_published_run"](spark, FOLDER)
    text = filtered._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "o_orderpriority" not in text


def test_date_filter_prunes_partitions(spark, tmp_path):
    from datetime import date

    from lakegate.operators.filters import FactFilter
    from lakegate.sources.store import SnapshotStore

    store = SnapshotStore(spark, str(tmp_path))
    fact = entry.queries()["trip_enriched"](spark, FOLDER)
    stored = store.write("r", "silver.trip_enriched", fact, partition_by="trip_date")
    assert stored.columns == fact.columns
    where = FactFilter(date(2024, 1, 5), date(2024, 1, 6), "Z03")
    plan = where.apply(stored)._jdf.queryExecution().executedPlan().toString()
    partition_part = plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "trip_date" in partition_part
    assert "EqualTo(start_zone_id,Z03)" in plan
    assert where.apply(stored).count() == where.apply(fact).count()
