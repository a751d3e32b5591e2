"""Layers on bucketed tables: the same rows, and no exchange below a join or a
group by the key."""

from __future__ import annotations

import pytest

from stepwise.plans import colocated as co
from stepwise.plans.catalog import fixture_marts
from stepwise.plans.views import create_database
from tests.conftest import SMOKE_DIR
from tests.test_plans import plan

BUCKETS = 4


@pytest.fixture(scope="module")
def marts(spark, tmp_path_factory):
    base = fixture_marts(spark, SMOKE_DIR)
    create_database(spark, "colocated_test", str(tmp_path_factory.mktemp("buckets")))
    tables = co.bucket(base, "colocated_test", BUCKETS)
    assert sorted(tables) == sorted([co.SESSION_EVENTS, co.USER_EVENTS, co.SESSION_ITEMS])
    return base, co.colocated(base, tables)


LAYERS = ["user_funnel_steps", "session_funnel_steps", "checkout_funnel_steps", "session_segments", "session_funnel_segmented", "category_session_funnel"]


@pytest.mark.parametrize("name", [*LAYERS, "funnel_summary", "channel_device_performance", "category_performance", "friction_score"])
def test_same_rows(marts, name):
    want, got = (getattr(m, name) for m in marts)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


@pytest.mark.parametrize("name", LAYERS)
def test_no_exchange_by_the_key(marts, name):
    p = plan(getattr(marts[1], name))
    assert "Exchange hashpartitioning" not in p
    assert f"Bucketed: true" in p or f"SelectedBucketsCount: {BUCKETS} out of {BUCKETS}" in p


def test_the_join_of_the_segments_starts_from_the_buckets(spark, marts):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(marts[1].channel_device_performance.select("*"))  # planned anew
        join = next(i for i, line in enumerate(p.splitlines()) if "SortMergeJoin" in line)
        below = p.splitlines()[join:]
        assert not any("Exchange" in line for line in below)
        assert any("Exchange" in line for line in p.splitlines()[:join])  # the groups of the mart, a few rows
        # Without buckets there are several.
        assert sum("Exchange hashpartitioning" in line for line in plan(marts[0].session_funnel_segmented.select("*")).splitlines()) >= 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_only_some_tables(spark, tmp_path):
    base = fixture_marts(spark, SMOKE_DIR)
    create_database(spark, "colocated_some", str(tmp_path / "some"))
    tables = co.bucket(base, "colocated_some", 2, only=[co.USER_EVENTS])
    assert list(tables) == [co.USER_EVENTS]
    got = co.colocated(base, tables)
    assert "session_funnel_steps" not in got.__dict__
    assert got.user_funnel_steps.count() == base.user_funnel_steps.count()
    assert tables[co.USER_EVENTS].where("user_pseudo_id IS NULL").count() == 0
