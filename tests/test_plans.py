"""Plan assertions: partition pruning on the sharded source, no Python in
any query, map-side partial aggregation and no window in the funnel, no job
while a layer is built, and one raw pass per source for the marts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stepwise.plans.catalog import Marts
from stepwise.sources.ga4 import read_raw_events, write_raw_events
from stepwise.sources.schema import EVENT_SCHEMA
from tests.conftest import SMOKE_DIR
from tests.rawrows import event, raw_df


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def sharded(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "events")
    rows = [event("view_item", i, date=d) for i, d in enumerate(["20201031", "20201101", "20210131", "20210201"])]
    write_raw_events(raw_df(spark, rows), path)
    return path


def test_partition_pruning(spark, sharded):
    raw = read_raw_events(spark, sharded, ("20201101", "20210131"))
    assert raw.count() == 2
    p = plan(Marts(raw).stg_events)
    assert "PartitionFilters: [isnotnull(event_date" in p
    assert "20201101" in p.split("PartitionFilters")[1][:300]


def test_column_pruning_reaches_scan(spark, sharded):
    raw = read_raw_events(spark, sharded, None)
    p = plan(Marts(raw).user_funnel_steps)
    scans = [line for line in p.splitlines() if "FileScan parquet" in line or "Scan parquet" in line]
    assert scans
    for s in scans:
        assert "items" not in s and "ecommerce" not in s  # nested columns not needed are not read


def test_no_python_anywhere(spark):
    from stepwise.plans.catalog import queries

    for name, q in queries().items():
        p = plan(q(spark, SMOKE_DIR))
        for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"):
            assert node not in p, (name, node)


def test_funnel_shape(spark, smoke_marts):
    p = plan(smoke_marts.user_funnel_steps)
    assert "Window" not in p  # no whole-key window buffers
    assert "partial_min" in p  # map-side combine before the shuffle


def _jobs(spark) -> int:
    """Jobs started so far in this session."""
    return spark.sparkContext._jsc.sc().dagScheduler().nextJobId()


def test_building_a_layer_starts_no_job(spark):
    from stepwise.plans.catalog import VIEW_NAMES, fixture_marts

    marts = fixture_marts(spark, SMOKE_DIR)
    marts.raw_all.schema  # the table's footer is read by now
    before = _jobs(spark)
    for name in VIEW_NAMES:
        getattr(marts, name)
    assert _jobs(spark) == before


@pytest.mark.parametrize("name, passes", [("funnel_summary", 1), ("category_performance", 1), ("data_quality_checks", 2)])
def test_marts_read_the_raw_table_once_per_source(spark, name, passes, monkeypatch):
    """Every read of the events table belongs to the narrow tables that are
    written first; the plan that is left reads those only."""
    from stepwise.plans import catalog

    written = []
    write_once = catalog.write_once

    def noted(df, tag):
        written.append(plan(df).count("events.parquet"))
        return write_once(df, tag)

    monkeypatch.setattr(catalog, "write_once", noted)
    rest = catalog.queries()[name](spark, SMOKE_DIR)
    assert sum(written) == passes
    assert "events.parquet" not in plan(rest)


def test_sharded_window_reads_only_its_days(spark, sharded):
    raw = read_raw_events(spark, sharded, ("20201101", "20201231"))
    assert len(raw.inputFiles()) == 1
    assert read_raw_events(spark, sharded, ("20190101", "20190107")).count() == 0


def test_baseline_is_a_scalar_subquery_not_a_join(spark, smoke_marts):
    p = plan(smoke_marts.revenue_leakage)
    assert "Subquery" in p
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p


def test_sharded_window_is_a_string_range(spark, tmp_path):
    path = str(tmp_path / "events")
    raw = spark.createDataFrame([], EVENT_SCHEMA)
    days = ["20201114", "20201115_fresh", "20201131", "20210131_fresh", "intraday_20201115"]
    for day in days:
        one = spark.range(1).select(*[F.lit(day if f.name == "event_date" else None).cast(f.dataType).alias(f.name) for f in raw.schema])
        one.write.mode("append").partitionBy("event_date").parquet(path)
    got = read_raw_events(spark, path, ("20201101", "20210131")).select("event_date").collect()
    assert sorted(r.event_date for r in got) == days[:3]
