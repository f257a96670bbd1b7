"""Plans and registry: what must not appear in a plan, and results equal to SQL."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as registry
import check
from energy_series.catalog import views as v
from energy_series.catalog.queries import QUERIES
from energy_series.operators import counters, grid
from energy_series.plans import trend
from energy_series.sources import tables

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in check.TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))  # folders that may be left out test their own
def test_query_equals_sql_and_is_distributed(spark, db, name):
    df = registry.queries()[name](spark, SMALL)
    plan = physical(df)
    for bad in ("SinglePartition", "Python", "CartesianProduct", "BroadcastNestedLoop"):
        assert bad not in plan, f"{bad} in the plan of {name}"
    oracle = registry.oracle_sql()[name]
    assert check.difference(df.toPandas(), db.execute(oracle).df()) is None


def test_entry(spark):
    df = registry.entry(spark)
    assert df.count() > 0 and "own_use_euro" in df.columns


def test_raw_rows_are_never_in_a_window_over_a_whole_site(spark):
    """Windows over a site alone come after an aggregation to buckets."""
    mains = spark.read.schema(
        "site_id string, sample_time timestamp_ntz, x bigint"
    ).parquet(SMALL + "/region.parquet")
    plan = physical(counters.bucket_delta(mains, ["x"], "15min"))
    exchanges = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert len(exchanges) == 2
    assert re.match(r"site_id#\d+, 4", exchanges[0]) and "_slice" in exchanges[1]
    short = physical(counters.bucket_delta(mains, ["x"], "15min", holes=False))
    assert short.count("Exchange") == 2 and short.count("Sort [") == 1
    assert "partial_max_by" in short.split("Exchange")[-1]


def test_energy_table_shuffles_raw_rows_and_quarter_hours_once(spark, tmp_path):
    stored = trend.Tables(
        *[tables.create_table(spark, n, str(tmp_path / n))
          for n in ("mains", "production", "prices", "battery")]
    )
    plan = physical(trend.trend_table(stored, "d", "2024-01-20", 480, holes=False))
    meters = plan[: plan.index("BroadcastExchange")]
    assert len(re.findall(r"Exchange hashpartitioning\(site_id#\d+, \w+#\d+, 4\)", meters)) == 2
    assert len(re.findall(r"Exchange hashpartitioning\(site_id#\d+, 4\)", meters)) == 1
    assert "SortMergeJoin" in meters and "sample_date" in plan


def test_resample_aggregates_before_its_first_shuffle(spark):
    ev = v.site_events(spark, SMALL)
    plan = physical(grid.resample(ev, "h", sums=["wh"]))
    assert "partial_sum" in plan.split("Exchange")[-1]


def test_scan_reads_only_needed_columns(spark):
    source = v.tables(spark, SMALL)
    plan = physical(trend.frame(trend.energy_quarters(source), "HOME", "d"))
    assert "props" not in plan
