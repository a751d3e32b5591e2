"""Property tests (Hypothesis): the ordered funnel equals its literal
definition for random step lists and event logs; counts
never increase along the steps; input order does not matter."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stepwise.operators.funnel import ordered_funnel
from tests.test_funnel import brute_force

NAMES = ["a", "b", "c", "d", "x"]
BASE = dt.datetime(2021, 1, 1)

events_strategy = st.lists(
    st.tuples(
        st.sampled_from(["k1", "k2", "k3", "hot", "hot", "hot"]),  # one key holds about half the rows
        st.sampled_from(NAMES),
        st.integers(min_value=0, max_value=12),  # few distinct times: many ties
    ),
    min_size=1,
    max_size=60,
)
steps_strategy = st.lists(st.sampled_from(NAMES[:4]), min_size=1, max_size=4, unique=True)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events=events_strategy, steps=steps_strategy)
def test_funnel_equals_definition(spark, events, steps):
    rows = [(k, n, BASE + dt.timedelta(minutes=m)) for k, n, m in events]
    df = spark.createDataFrame(rows, "k string, event_name string, event_time timestamp")
    out = ordered_funnel(df, ["k"], steps).collect()
    got = {r.k: tuple(r[f"{s}_time"] for s in steps) for r in out}
    want = brute_force(rows, steps)
    assert got == want
    # Reaching a step implies reaching every earlier one; times never decrease.
    for times in got.values():
        reached = [t is not None for t in times]
        assert reached == sorted(reached, reverse=True)
        present = [t for t in times if t is not None]
        assert present == sorted(present)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events=events_strategy)
def test_funnel_ignores_input_order_and_partitioning(spark, events):
    rows = [(k, n, BASE + dt.timedelta(minutes=m)) for k, n, m in events]
    steps = ["a", "b", "c"]
    one = spark.createDataFrame(rows, "k string, event_name string, event_time timestamp")
    other = spark.createDataFrame(list(reversed(rows)), "k string, event_name string, event_time timestamp").repartition(3)
    a = sorted(tuple(r) for r in ordered_funnel(one, ["k"], steps).collect())
    b = sorted(tuple(r) for r in ordered_funnel(other, ["k"], steps).collect())
    assert a == b


def test_repeated_step_names_are_rejected(spark):
    import pytest

    df = spark.createDataFrame([("k", "a", BASE)], "k string, event_name string, event_time timestamp")
    with pytest.raises(ValueError, match="distinct"):
        ordered_funnel(df, ["k"], ["a", "b", "a"])
