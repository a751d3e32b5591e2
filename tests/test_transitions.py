"""The one-scan funnel: equal to the literal definition and to the funnel by
joins at every length of ranges, one scan in the plan, a hot key spread."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stepwise.operators.funnel import ordered_funnel
from stepwise.operators.transitions import transition_funnel
from stepwise.plans.funnels import MAIN_STEPS
from tests.test_funnel import brute_force
from tests.test_plans import plan

BASE = dt.datetime(2021, 1, 1)
SCHEMA = "k string, event_name string, event_time timestamp"


def times(df, steps):
    return {r.k: tuple(r[f"{s}_time"] for s in steps) for r in df.collect()}


@pytest.mark.parametrize("ranges", [(1,), (300,), (60, 3600, 86_400), (10**9,)])
def test_any_ranges_equal_the_definition(spark, ranges):
    rng = random.Random(5)
    events = []
    for _ in range(900):
        k = f"k{rng.randrange(60)}" if rng.random() > 0.3 else "hot"
        events.append((k, rng.choice([*MAIN_STEPS, "page_view"]), BASE + dt.timedelta(seconds=rng.choice([7, 60, 3601]) * rng.randrange(40))))
    df = spark.createDataFrame(events, SCHEMA)
    assert times(transition_funnel(df, ["k"], MAIN_STEPS, ranges=ranges), MAIN_STEPS) == brute_force(events, MAIN_STEPS)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    events=st.lists(
        st.tuples(st.sampled_from(["k1", "k2", "hot", "hot"]), st.sampled_from(["a", "b", "c", "d", "x"]), st.integers(0, 12)),
        min_size=1,
        max_size=60,
    ),
    steps=st.lists(st.sampled_from(["a", "b", "c", "d"]), min_size=1, max_size=4, unique=True),
    minutes=st.sampled_from([1, 2, 5, 60]),
)
def test_random_logs(spark, events, steps, minutes):
    rows = [(k, n, BASE + dt.timedelta(minutes=m)) for k, n, m in events]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = brute_force(rows, steps)
    assert times(transition_funnel(df, ["k"], steps, ranges=(60 * minutes, 3600)), steps) == want


def test_equal_to_the_funnel_by_joins(spark, smoke_marts):
    for keys in (["user_pseudo_id"], ["session_key", "user_pseudo_id"]):
        one = transition_funnel(smoke_marts.stg_events, keys, MAIN_STEPS)
        other = ordered_funnel(smoke_marts.stg_events, keys, MAIN_STEPS)
        assert one.columns == other.columns
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))


@pytest.mark.parametrize("layer", ["user_funnel_steps", "session_funnel_steps", "checkout_funnel_steps", "category_session_funnel"])
def test_a_funnel_scans_the_events_once(spark, smoke_marts, layer):
    p = plan(getattr(smoke_marts, layer))
    assert p.count("Scan parquet") == 1
    assert "Join" not in p and "Window" not in p


def test_a_hot_key_is_spread_over_its_ranges(spark):
    """No group that is formed holds more of a key than a range has, and the
    first step is one row per range before it is shuffled."""
    n = 20_000
    events = spark.range(n).select(
        F.lit("bot").alias("k"),
        F.when(F.col("id") % 10 == 0, F.lit("add_to_cart")).otherwise(F.lit("view_item")).alias("event_name"),
        F.timestamp_seconds(F.col("id") * 30).alias("event_time"),
    )
    out = transition_funnel(events, ["k"], MAIN_STEPS[:2], ranges=(300,))
    assert [tuple(r) for r in out.select(F.unix_micros("view_item_time"), F.unix_micros("add_to_cart_time")).collect()] == [(30_000_000, 300_000_000)]
    exchanges = [line for line in plan(out).splitlines() if "Exchange hashpartitioning" in line]
    assert sum("_range" in line for line in exchanges) == 2 and len(exchanges) == 3


def test_null_keys_and_times_and_wrong_ranges(spark):
    rows = [(None, "view_item", BASE), ("a", "view_item", None), ("b", "view_item", BASE), ("c", "add_to_cart", BASE)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert times(transition_funnel(df, ["k"], MAIN_STEPS), MAIN_STEPS) == {"b": (BASE, None, None, None)}
    assert transition_funnel(df.where("false"), ["k"], MAIN_STEPS).count() == 0
    for ranges in ((), (0,), (300, 500)):
        with pytest.raises(ValueError, match="ranges"):
            transition_funnel(df, ["k"], MAIN_STEPS, ranges=ranges)
    with pytest.raises(ValueError, match="distinct"):
        transition_funnel(df, ["k"], ["a", "a"])


def test_a_range_gathers_its_steps_once_and_most_hold_one(spark, smoke_marts):
    funnel = transition_funnel(smoke_marts.stg_events, ["user_pseudo_id"], MAIN_STEPS)
    # One list per range, however many steps; one per key.
    assert plan(funnel).count("partial_collect_list(") == 2
    at = dt.datetime(2024, 1, 1)
    events = [("a", MAIN_STEPS[0], 0), ("a", MAIN_STEPS[1], 400), ("a", MAIN_STEPS[3], 800), ("a", MAIN_STEPS[2], 1200), ("b", MAIN_STEPS[1], 0), ("b", MAIN_STEPS[0], 400)]
    rows = [(k, e, at + dt.timedelta(seconds=s)) for k, e, s in events]
    got = transition_funnel(spark.createDataFrame(rows, "k string, event_name string, event_time timestamp"), ["k"], MAIN_STEPS)
    assert {(r[0], *[t is not None for t in r[1:]]) for r in got.collect()} == {("a", True, True, True, False), ("b", True, False, False, False)}
