"""Column rules: every branch of the channel, category, status, tier and
friction-text rules, key lookups, null propagation, safe division."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stepwise.functions import columns as C
from stepwise.operators.staging import stg_events, stg_items
from tests.rawrows import event, item, raw_df


def one(spark, expr, schema="a string, b string", row=("x", "y")):
    return spark.createDataFrame([row], schema).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "source,medium,expected",
    [
        ("google", "organic", "Google Organic"),
        ("google", "cpc", "Google CPC"),
        ("(direct)", "(none)", "Direct"),
        ("anything", "referral", "Referral"),
        ("google", "referral", "Referral"),
        ("(data deleted)", None, "Data Deleted / Unknown"),
        (None, "(data deleted)", "Data Deleted / Unknown"),
        ("<other>", "<other>", "Other"),
        (None, None, "Other"),
        ("google", None, "Other"),
    ],
)
def test_traffic_channel(spark, source, medium, expected):
    assert one(spark, C.traffic_channel("a", "b"), row=(source, medium)) == expected


@pytest.mark.parametrize(
    "raw,expected",
    [
        ("Home/Apparel", "Apparel"),
        ("Apparel/Bags", "Apparel"),
        ("Womens", "Apparel"),
        ("Writing Instruments", "Apparel"),  # '%men%' inside 'instruments': kept on purpose
        ("Drinkware", "Drinkware"),
        ("Bags", "Bags"),
        ("Office/Stationery", "Stationery"),
        ("Shop Sale", "Sale"),
        (None, "Unknown"),
        ("", "Unknown"),
        ("  ", "Unknown"),
        ("\t", "Unknown"),
        ("(not set)", "Other"),
        ("Electronics", "Other"),
    ],
)
def test_clean_category(spark, raw, expected):
    assert one(spark, C.clean_category("a"), row=(raw, None)) == expected


def test_param_lookup_first_match_missing_and_null(spark):
    rows = [
        event("view_item", 0, params=[("ga_session_id", (None, 7)), ("ga_session_id", (None, 8))]),
        event("view_item", 1, params=[("page_location", ("p", None))]),
        event("view_item", 2, params=[("ga_session_id", ("s", None))]),
        event("view_item", 3, params=[]),
    ]
    out = stg_events(raw_df(spark, rows)).orderBy("event_timestamp").collect()
    assert [r.ga_session_id for r in out] == [7, None, None, None]
    assert [r.session_key for r in out] == ["u1-7", None, None, None]
    assert [r.page_location for r in out] == [None, "p", None, None]


def test_session_key_null_user(spark):
    out = stg_events(raw_df(spark, [event("view_item", 0, user=None, session=5)])).first()
    assert out.ga_session_id == 5 and out.session_key is None


def test_staging_fields_and_window(spark):
    rows = [
        event("purchase", 0, transaction="T1", revenue=12.5, source="Google", medium="CPC", device="Mobile"),
        event("view_item", 1, date="20210201"),
        event("view_item", 2, date="intraday_20201101"),
    ]
    raw = raw_df(spark, rows)
    out = stg_events(raw, ("20201101", "20210131")).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.traffic_source, r.traffic_medium, r.traffic_channel, r.device_category) == (
        "google",
        "cpc",
        "Google CPC",
        "mobile",
    )
    assert (r.transaction_id, r.purchase_revenue, str(r.event_date)) == ("T1", 12.5, "2020-11-01")
    assert r.traffic_campaign == "(camp)"


def test_items_unnest_drops_null_and_empty(spark):
    rows = [
        event("view_item", 0, items=None),
        event("view_item", 1, items=[]),
        event("view_item", 2, items=[item("Bags"), item(None, item_id="i2")]),
    ]
    out = stg_items(raw_df(spark, rows)).orderBy("item_id").collect()
    assert [(r.item_id, r.raw_item_category, r.cleaned_item_category) for r in out] == [
        ("i1", "Bags", "Bags"),
        ("i2", None, "Unknown"),
    ]


def test_safe_divide(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (3, 4), (0, 5)], "a long, b long")
    assert [r.r for r in df.select(C.safe_divide("a", "b").alias("r")).collect()] == [None, None, 0.75, 0.0]


@pytest.mark.parametrize(
    "value,leak,fric",
    [
        (None, "Low", "Low"),
        (0.0, "Low", "Low"),
        (25.0, "Low", "Medium"),
        (50.0, "Low", "High"),
        (75.0, "Low", "Critical"),
        (100_000.0, "Medium", "Critical"),
        (500_000.0, "High", "Critical"),
        (1_000_000.0, "Very High", "Critical"),
    ],
)
def test_tiers(spark, value, leak, fric):
    df = spark.createDataFrame([(value,)], "v double")
    r = df.select(C.leakage_priority("v").alias("l"), C.friction_priority("v").alias("f")).first()
    assert (r.l, r.f) == (leak, fric)


def test_friction_texts(spark):
    labels = [t for t, _, _ in C.FRICTION_RULES] + ["X → Y"]
    df = spark.createDataFrame([(t,) for t in labels], "t string")
    out = df.select("t", C.likely_business_issue("t").alias("i"), C.recommended_investigation("t").alias("r"))
    got = {r.t: (r.i, r.r) for r in out.collect()}
    for t, issue, rec in C.FRICTION_RULES:
        assert got[t] == (issue, rec)
    assert got["X → Y"] == (C.FRICTION_DEFAULT_ISSUE, C.FRICTION_DEFAULT_RECOMMENDATION)


def test_round_half_up(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (93.1149,)], "v double")
    assert [r.r for r in df.select(F.round("v", 2).alias("r")).collect()] == [0.13, -0.13, 93.11]


def test_transaction_dedup_and_baseline(spark):
    from stepwise.plans.revenue import revenue_baseline, transaction_revenue

    rows = [
        event("purchase", 0, transaction="T1", revenue=10.0),
        event("purchase", 1, transaction="T1", revenue=30.0),  # repeated id, other revenue -> max
        event("purchase", 2, transaction="(not set)", revenue=5.0),  # placeholder ids are kept
        event("purchase", 3, transaction=None, revenue=99.0),  # no id -> out
        event("purchase", 4, transaction="T2", revenue=None),  # no revenue -> out
        event("page_view", 5, transaction="T3", revenue=50.0),  # not a purchase -> out
    ]
    tr = transaction_revenue(stg_events(raw_df(spark, rows)))
    assert sorted((r.transaction_id, r.transaction_revenue) for r in tr.collect()) == [("(not set)", 5.0), ("T1", 30.0)]
    b = revenue_baseline(tr).first()
    assert (b.unique_transactions, b.total_purchase_revenue, b.average_order_value) == (2, 35.0, 17.5)
