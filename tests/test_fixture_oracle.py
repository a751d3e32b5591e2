"""Driver-table mapping: regression counts, oracle parity of every key,
the entry smoke check, and the failing path of the quality checks."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMOKE_DIR
from tools.compare import digest

# Regression counts of the mapping at sf0.001.
EXPECTED_SF0001 = {
    "events": 1000,
    "users": 15,
    "null_session_key": 19,
    "items": 1011,
    "user": (15, 12, 10, 8),
    "session": (64, 41, 21, 11),
    "checkout": (50, 35, 15, 6),
    "category": (88, 44, 19, 6),
    "purchase": (157, 104, 143),
    "dedup": (98, 6138.56),
    "multi_channel_sessions": 56,
}


def sums(df, cols):
    return tuple(df.agg(*[F.sum(c) for c in cols]).first())


def test_mapping_counts(smoke_marts):
    m = smoke_marts
    e = EXPECTED_SF0001
    assert m.stg_events.count() == e["events"]
    assert m.stg_events.select(F.countDistinct("user_pseudo_id")).first()[0] == e["users"]
    assert m.stg_events.where(F.col("session_key").isNull()).count() == e["null_session_key"]
    assert m.stg_items.count() == e["items"]
    main = ["viewed_item", "added_to_cart", "began_checkout", "purchased"]
    assert sums(m.user_funnel_steps, main) == e["user"]
    assert sums(m.session_funnel_steps, main) == e["session"]
    assert sums(m.checkout_funnel_steps, ["began_checkout", "added_shipping_info", "added_payment_info", "purchased"]) == e["checkout"]
    assert sums(m.category_session_funnel, main) == e["category"]
    a = m.purchase_audit.first()
    assert (a.purchase_events, a.unique_transaction_ids, a.purchases_with_revenue) == e["purchase"]
    b = m.revenue_baseline.first()
    assert b.unique_transactions == e["dedup"][0]
    assert round(b.total_purchase_revenue, 2) == e["dedup"][1]
    # Sessions whose events carry more than one (source, medium) pair (nulls count as values).
    pair = F.concat_ws("|", F.coalesce("traffic_source", F.lit("<null>")), F.coalesce("traffic_medium", F.lit("<null>")))
    multi = (
        m.stg_events.where(F.col("session_key").isNotNull())
        .groupBy("session_key")
        .agg(F.countDistinct(pair).alias("n"))
        .where("n > 1")
        .count()
    )
    assert multi == e["multi_channel_sessions"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SMOKE_DIR}/events.parquet')")
    return con


def _keys():
    # The driver-table queries; those of the training-data operators have
    # their own tests beside them.
    from stepwise.plans.catalog import queries

    return list(queries())


@pytest.mark.parametrize("name", _keys())
def test_oracle_parity(spark, duck, name):
    from __spark_entry__ import oracle_sql, queries

    df = queries()[name](spark, SMOKE_DIR)
    sql = oracle_sql()[name]
    res = duck.execute(sql)
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    s_rows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert digest(s_rows, df.columns) == digest(o_rows, o_cols)


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    rows = df.collect()
    assert len(rows) == 9
    assert df.columns[:3] == ["funnel_type", "unit_type", "step_order"]


def test_window_excludes_rows(spark):
    from stepwise.plans.catalog import fixture_marts, queries

    inside = queries()["windowed_events"](spark, SMOKE_DIR).groupBy().sum("event_count").first()[0]
    assert 0 < inside < fixture_marts(spark, SMOKE_DIR).stg_events.count()


def test_every_label_occurs_with_scaled_bounds(spark):
    from stepwise.plans.catalog import queries

    sf = SMOKE_DIR.replace("0.001", "0.01")
    tiers = {r.leakage_priority for r in queries()["scaled_revenue_leakage"](spark, sf).collect()}
    assert tiers == {"Very High", "High", "Medium", "Low"}
    volume = {r.is_high_volume_category for r in queries()["scaled_category_performance"](spark, sf).collect()}
    assert volume == {True, False}


def test_channel_segments_sum_to_session_funnel(smoke_marts):
    main = ["viewed_item_sessions", "added_to_cart_sessions", "began_checkout_sessions", "purchased_sessions"]
    assert sums(smoke_marts.channel_device_performance, main) == EXPECTED_SF0001["session"]


def test_quality_checks_failing_path(smoke_marts):
    checks = {r.check_name: r for r in smoke_marts.data_quality_checks.collect()}
    assert len(checks) == 8
    # The mapping injects null session keys on funnel events by design.
    assert checks["key_funnel_events_no_null_sessions"].check_status == "FAIL"
    assert checks["key_funnel_events_no_null_sessions"].check_value > 0
    assert checks["stg_events_not_empty"].check_value == 1000
    assert checks["stg_events_not_empty"].check_status == "PASS"
    assert checks["funnel_counts_do_not_increase"].check_value == 0
