"""Ordered funnel: hand-made edge cases, brute-force equivalence on random
logs, and adaptive splitting of a hot key."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from stepwise.operators.funnel import ordered_funnel
from stepwise.operators.staging import stg_events
from stepwise.plans.funnels import (
    CHECKOUT_STEPS,
    MAIN_STEPS,
    checkout_funnel_steps,
    session_funnel_steps,
    user_funnel_steps,
)
from tests.rawrows import event, raw_df

def flags(df, key="user_pseudo_id"):
    return {
        r[key]: (r.viewed_item, r.added_to_cart, r.began_checkout, r.purchased)
        for r in df.collect()
    }


def test_same_timestamp_satisfies_every_step(spark):
    rows = [event(n, 5, user="a") for n in MAIN_STEPS]
    out = user_funnel_steps(stg_events(raw_df(spark, rows))).first()
    assert (out.added_to_cart, out.began_checkout, out.purchased) == (1, 1, 1)
    assert out.minutes_from_view_to_purchase == 0
    assert out.final_funnel_status == "Purchased"


def test_order_rules(spark):
    rows = [
        # b: cart before view only -> stops at view
        event("add_to_cart", 0, user="b"),
        event("view_item", 1, user="b"),
        # c: two views with a cart between -> cart counts (>= first view)
        event("view_item", 0, user="c"),
        event("add_to_cart", 1, user="c"),
        event("view_item", 2, user="c"),
        # d: checkout without cart -> stops at view
        event("view_item", 0, user="d"),
        event("begin_checkout", 1, user="d"),
        event("purchase", 2, user="d"),
        # e: purchase before checkout -> stops at checkout
        event("view_item", 0, user="e"),
        event("add_to_cart", 1, user="e"),
        event("purchase", 2, user="e"),
        event("begin_checkout", 3, user="e"),
        # f: never viewed -> absent
        event("add_to_cart", 0, user="f"),
        # null user -> ignored by the user funnel
        event("view_item", 0, user=None),
        # unknown events ignored
        event("page_view", 0, user="g"),
        event("view_item", 1, user="g"),
        event("add_to_cart", 61.5, user="g"),
        event("begin_checkout", 62, user="g"),
        event("purchase", 63.9, user="g"),
    ]
    out = user_funnel_steps(stg_events(raw_df(spark, rows)))
    got = flags(out)
    assert got == {
        "b": (1, 0, 0, 0),
        "c": (1, 1, 0, 0),
        "d": (1, 0, 0, 0),
        "e": (1, 1, 1, 0),
        "g": (1, 1, 1, 1),
    }
    status = {r.user_pseudo_id: (r.final_funnel_status, r.minutes_from_view_to_purchase) for r in out.collect()}
    assert status["e"] == ("Dropped After Checkout", None)
    assert status["c"] == ("Dropped After Cart", None)
    assert status["b"] == ("Dropped After Product View", None)
    assert status["g"] == ("Purchased", 62)  # 62.9 minutes truncates to 62


def test_session_and_checkout_funnels(spark):
    rows = [
        event("view_item", 0, user="a", session=1),
        event("add_to_cart", 1, user="a", session=2),  # other session
        event("begin_checkout", 2, user="a", session=2),
        event("add_shipping_info", 3, user="a", session=2),
        event("add_payment_info", 4, user="a", session=2),
        event("purchase", 5, user="a", session=2),
        event("begin_checkout", 0, user="a", session=None),  # no session key
    ]
    ev = stg_events(raw_df(spark, rows))
    s = {r.session_key: (r.user_pseudo_id, r.added_to_cart) for r in session_funnel_steps(ev).collect()}
    assert s == {"a-1": ("a", 0)}
    c = checkout_funnel_steps(ev).collect()
    assert [(r.session_key, r.added_shipping_info, r.added_payment_info, r.purchased) for r in c] == [
        ("a-2", 1, 1, 1)
    ]


def brute_force(events, steps):
    """Literal definition, one key at a time in Python."""
    by_key = {}
    for k, name, t in events:
        by_key.setdefault(k, []).append((name, t))
    out = {}
    for k, evs in by_key.items():
        times = []
        prev = None
        for i, s in enumerate(steps):
            cand = [t for n, t in evs if n == s and (i == 0 or (prev is not None and t >= prev))]
            prev = min(cand) if cand else None
            times.append(prev)
        if times[0] is not None:
            out[k] = tuple(times)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cascade_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    base = dt.datetime(2021, 1, 1)
    names = MAIN_STEPS + ["page_view"]
    events = []
    for _ in range(700):
        k = f"k{rng.randrange(40)}" if rng.random() > 0.3 else "hot"  # one key with ~30% of rows
        t = base + dt.timedelta(minutes=rng.randrange(50))  # heavy time ties
        events.append((k, rng.choice(names), t))
    df = spark.createDataFrame(events, "k string, event_name string, event_time timestamp")
    got = {
        r.k: tuple(r[f"{s}_time"] for s in MAIN_STEPS)
        for r in ordered_funnel(df, ["k"], MAIN_STEPS).collect()
    }
    assert got == brute_force(events, MAIN_STEPS)


def test_checkout_steps_any_entry(spark):
    rows = [event("begin_checkout", 0, user="z", session=3)]
    out = checkout_funnel_steps(stg_events(raw_df(spark, rows))).collect()
    assert [(r.session_key, r.began_checkout, r.added_shipping_info) for r in out] == [("z-3", 1, 0)]
    assert CHECKOUT_STEPS[0] == "begin_checkout"


HOT_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def splitting(spark):
    """Small thresholds, and no broadcasts, for the length of a test."""
    old = {k: spark.conf.get(k, None) for k in HOT_CONF}
    for k, v in HOT_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_adaptive_execution_splits_a_hot_key(splitting):
    """A key with half of the rows: both joins of a three-step funnel are
    split, each step is joined once, and the result is the definition's."""
    rng = random.Random(4)
    base = dt.datetime(2021, 1, 1)
    steps = MAIN_STEPS[:3]
    events = [
        (f"k{rng.randrange(3000)}" if i % 2 else "hot", steps[i % 3], base + dt.timedelta(seconds=rng.randrange(90_000)))
        for i in range(30_000)
    ]
    df = splitting.createDataFrame(events, "k string, event_name string, event_time timestamp").repartition(8)
    out = ordered_funnel(df, ["k"], steps)
    got = {r.k: tuple(r[f"{s}_time"] for s in steps) for r in out.collect()}
    final = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("SortMergeJoin(skew=true)") == 2
    assert final.count("SortMergeJoin") == 2
    assert got == brute_force(events, steps)


def test_a_funnel_runs_one_join_per_later_step(splitting):
    """Exchanges are reused: three joins for four steps, and hash aggregates
    only."""
    events = [("a", s, dt.datetime(2021, 1, 1)) for s in MAIN_STEPS]
    df = splitting.createDataFrame(events, "k string, event_name string, event_time timestamp")
    out = ordered_funnel(df, ["k"], MAIN_STEPS)
    assert len(out.collect()) == 1
    final = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("SortMergeJoin") == 3
    assert "SortAggregate" not in final
