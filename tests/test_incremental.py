"""State over loads (transactions, sketches), checks observed while writing,
and windows that prune folders at run time."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from stepwise.plans import incremental as inc
from stepwise.plans import quality, revenue
from stepwise.plans.catalog import Marts, fixture_marts
from stepwise.plans.pipeline import run_checked
from stepwise.sources.fixture import load_raw
from stepwise.sources.ga4 import events_in_windows, read_raw_events, write_raw_events
from tests.conftest import SMOKE_DIR
from tests.test_plans import plan


@pytest.fixture(scope="module")
def events(spark):
    return fixture_marts(spark, SMOKE_DIR).stg_events.cache()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ------------------------------------------------------------ transactions --
def test_loads_in_any_order_give_a_full_run(spark, events, tmp_path):
    days = [r.event_date for r in events.select("event_date").distinct().orderBy("event_date").collect()]
    state = inc.TransactionState(spark, str(tmp_path / "state")).create()
    assert state.version() == 0 and state.transactions().count() == 0
    parts = [days[10:20], days[:12], days[18:], days[5:15]]  # overlapping, late and replayed
    for i, part in enumerate(parts):
        assert state.merge(events.where(F.col("event_date").isin(part)), f"load {i}") == i + 1
    want = revenue.transaction_revenue(events)
    assert rows(state.transactions()) == rows(want)
    assert rows(revenue.revenue_baseline(state.transactions())) == rows(revenue.revenue_baseline(want))
    before = rows(state.transactions())
    state.merge(events, "all of it again")
    assert rows(state.transactions()) == before
    assert [r.load for r in state.loads().orderBy("version").collect()] == [*(f"load {i}" for i in range(4)), "all of it again"]
    # Another reader finds the same state.
    assert rows(inc.TransactionState(spark, str(tmp_path / "state")).create().transactions()) == before


def test_a_load_that_fails_changes_nothing(spark, events, tmp_path):
    state = inc.TransactionState(spark, str(tmp_path / "state")).create()
    state.merge(events, "first")
    before = rows(state.transactions())
    # What a merge that died after writing half of its version leaves behind.
    os.makedirs(str(tmp_path / "state" / "version=2"))
    (tmp_path / "state" / "version=2" / "part-0.parquet").write_bytes(b"half")
    assert state.version() == 1 and rows(state.transactions()) == before
    assert state.merge(events.limit(0), "second") == 2
    assert rows(state.transactions()) == before


def test_a_transaction_keeps_its_greatest_revenue(spark, tmp_path):
    schema = "event_name string, transaction_id string, purchase_revenue double"
    state = inc.TransactionState(spark, str(tmp_path / "state")).create()
    for i, load in enumerate([[("purchase", "a", 5.0), ("purchase", "b", None)], [("purchase", "a", 3.0), ("purchase", "b", 1.0)], [("view_item", "a", 9.0), ("purchase", None, 2.0)]]):
        state.merge(spark.createDataFrame(load, schema), str(i))
    assert rows(state.transactions()) == [("a", 5.0), ("b", 1.0)]


# ---------------------------------------------------------------- sketches --
def test_merged_sketches_are_near_the_exact_counts(spark, tmp_path):
    events = fixture_marts(spark, "/root/testdata/sf0.01").stg_events
    path = str(tmp_path / "sketches")
    inc.write_sketches(inc.daily_sketches(events), path)
    daily = inc.read_sketches(spark, path)
    exact = events.agg(F.countDistinct("user_pseudo_id"), F.countDistinct("session_key"), F.count(F.lit(1))).first()
    got = inc.merged_counts(daily).first()
    assert got.event_count == exact[2] and got.days == daily.count()
    for estimate, true in ((got.estimated_users, exact[0]), (got.estimated_sessions, exact[1])):
        assert abs(estimate - true) <= 5 * inc.STANDARD_ERROR * true
    one = daily.orderBy("event_date").first()
    same = events.where(F.col("event_date") == one.event_date).agg(F.countDistinct("user_pseudo_id")).first()[0]
    assert one.users == same
    # The sum over days would be far off: days share users.
    assert daily.agg(F.sum("users")).first()[0] > 2 * exact[0]
    assert "Scan parquet" in plan(inc.merged_counts(daily)) and "events.parquet" not in plan(inc.merged_counts(daily))


def test_a_day_of_sketches_is_replaced(spark, events, tmp_path):
    path = str(tmp_path / "sketches")
    day = events.agg(F.min("event_date")).first()[0]
    inc.write_sketches(inc.daily_sketches(events.where("event_name <> 'view_item'")), path)
    inc.write_sketches(inc.daily_sketches(events.where(F.col("event_date") == day)), path)
    got = {r.event_date: r.event_count for r in inc.read_sketches(spark, path).collect()}
    assert got[day] == events.where(F.col("event_date") == day).count()
    assert sum(got.values()) < events.count()


# ------------------------------------------------------------------ checks --
def test_checks_observed_while_writing(spark, smoke_marts, tmp_path):
    got = run_checked(load_raw(spark, SMOKE_DIR), None, str(tmp_path / "out"))
    assert list(map(tuple, got.collect())) == list(map(tuple, smoke_marts.data_quality_checks.collect()))
    assert got.schema.simpleString() == smoke_marts.data_quality_checks.schema.simpleString()
    p = plan(got)
    assert "Scan parquet" not in p and "Exchange hashpartitioning" not in p  # nothing is read again
    assert len(os.listdir(tmp_path / "out")) == 6


def test_checks_need_every_layer_once(spark, smoke_marts):
    seen = quality.Observed()
    df = smoke_marts.funnel_summary
    assert seen.watch("session_segments", df) is df
    seen.watch("funnel_summary", df)
    with pytest.raises(ValueError, match="watched already"):
        seen.watch("funnel_summary", df)
    with pytest.raises(ValueError, match="not written yet"):
        seen.result(spark)


def test_observed_checks_of_bad_rows(spark, tmp_path):
    seen = quality.Observed()
    bad = spark.createDataFrame([(2, 9, 5, 1.8, 0.5, 0.1), (1, 5, None, None, None, None)], "step_order int, reached_count long, previous_step_count long, step_conversion_rate double, overall_conversion_rate double, dropoff_rate double")
    seen.watch("funnel_summary", bad).write.parquet(str(tmp_path / "bad"))
    got = seen.seen["funnel_summary"].get
    assert (got["_v0"], got["_v1"]) == (1, 1)


# ----------------------------------------------------------------- windows --
@pytest.fixture(scope="module")
def sharded(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("windows") / "events")
    write_raw_events(load_raw(spark, SMOKE_DIR), path)
    return read_raw_events(spark, path, None)


def test_windows_prune_folders_at_run_time(spark, sharded):
    windows = spark.createDataFrame([("a", "20240103", "20240104"), ("b", "20240104", "20240104"), ("none", "20240109", "20240101")], "window string, lo string, hi string")
    seen = events_in_windows(sharded, windows)
    got = {r.window: r.n for r in seen.groupBy("window").agg(F.count(F.lit(1)).alias("n")).collect()}
    of = {r.event_date: r.n for r in sharded.groupBy("event_date").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {"a": of["20240103"] + of["20240104"], "b": of["20240104"]}
    p = plan(seen)
    assert "dynamicpruning" in p.lower()
    assert len({r.f for r in seen.select(F.input_file_name().alias("f")).distinct().collect()}) >= 1


def test_pruned_scan_reads_the_folders_of_the_windows_only(spark, sharded):
    windows = spark.createDataFrame([("a", "20240103", "20240104")], "window string, lo string, hi string")
    seen = events_in_windows(sharded, windows)
    seen.collect()
    metrics = seen._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in metrics.split("PartitionFilters")[1][:200]
    days = {r.event_date for r in seen.select("event_date").distinct().collect()}
    assert days == {"20240103", "20240104"}


def test_a_mart_over_the_windows_equals_one_over_its_days(spark, sharded):
    windows = spark.createDataFrame([("week", "20240108", "20240114")], "window string, lo string, hi string")
    got = Marts(events_in_windows(sharded, windows).drop("window")).funnel_summary
    want = Marts(load_raw(spark, SMOKE_DIR), ("20240108", "20240114")).funnel_summary
    assert rows(got) == rows(want)
