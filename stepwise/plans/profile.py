"""Profiling reads and field audits over the raw and staged events.

All are global or low-cardinality aggregates with map-side partial
aggregation; the two samples are explicit top-n reads (``orderBy + limit``
plans as a per-partition top-n, bounded by n).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepwise.functions.columns import exact_sum
from stepwise.plans.funnels import CHECKOUT_STEPS, MAIN_STEPS

# Funnel events audited for session coverage: both funnels' steps.
KEY_FUNNEL_EVENTS = list(dict.fromkeys(MAIN_STEPS + CHECKOUT_STEPS))
SAMPLE_ROWS = 100


def event_name_counts(raw: DataFrame) -> DataFrame:
    return raw.groupBy("event_name").agg(F.count(F.lit(1)).alias("event_count")).orderBy(
        F.desc("event_count"), "event_name"
    )


def dataset_profile(raw: DataFrame) -> DataFrame:
    day = F.to_date("event_date", "yyyyMMdd")
    return raw.agg(
        F.min(day).alias("min_event_date"),
        F.max(day).alias("max_event_date"),
        F.count(F.lit(1)).alias("total_events"),
        F.countDistinct("user_pseudo_id").alias("total_users"),
    )


def daily_totals(stg_events: DataFrame) -> DataFrame:
    """Per day: events, users, sessions, purchases and their revenue."""
    return stg_events.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.countDistinct("user_pseudo_id").alias("users"),
        F.countDistinct("session_key").alias("sessions"),
        F.count_if(F.col("event_name") == "purchase").alias("purchase_events"),
        exact_sum("purchase_revenue").alias("purchase_revenue"),
    )


def null_session_audit(stg_events: DataFrame) -> DataFrame:
    """Per key funnel event: events, null session ids, null session keys."""
    return (
        stg_events.where(F.col("event_name").isin(KEY_FUNNEL_EVENTS))
        .groupBy("event_name")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.count_if(F.col("ga_session_id").isNull()).alias("null_session_id_count"),
            F.count_if(F.col("session_key").isNull()).alias("null_session_key_count"),
        )
    )


def purchase_audit(stg_events: DataFrame) -> DataFrame:
    """Purchase events vs unique transactions vs revenue coverage."""
    p = stg_events.where(F.col("event_name") == "purchase")
    return p.agg(
        F.count(F.lit(1)).alias("purchase_events"),
        F.countDistinct("transaction_id").alias("unique_transaction_ids"),
        F.count_if(F.col("transaction_id").isNull()).alias("purchases_without_transaction_id"),
        F.count_if(F.col("purchase_revenue").isNotNull()).alias("purchases_with_revenue"),
        F.count_if(F.col("purchase_revenue").isNull()).alias("purchases_without_revenue"),
    )


def traffic_device_coverage(stg_events: DataFrame) -> DataFrame:
    return stg_events.groupBy("traffic_source", "traffic_medium", "device_category").agg(
        F.count(F.lit(1)).alias("event_count")
    )


def traffic_channels(stg_events: DataFrame) -> DataFrame:
    """Channel assigned to every (source, medium) pair seen, with volume."""
    return stg_events.groupBy("traffic_source", "traffic_medium", "traffic_channel").agg(
        F.count(F.lit(1)).alias("event_count")
    )


def category_coverage(stg_items: DataFrame) -> DataFrame:
    return stg_items.groupBy("raw_item_category", "cleaned_item_category").agg(
        F.count(F.lit(1)).alias("item_rows")
    )


def event_field_sample(raw: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """The 11 fields of the field check, first ``n`` rows in event order."""
    return (
        raw.select(
            "event_date",
            F.timestamp_micros("event_timestamp").alias("event_time"),
            "event_name",
            "user_pseudo_id",
            "platform",
            F.col("device.category").alias("device_category"),
            F.col("traffic_source.source").alias("traffic_source"),
            F.col("traffic_source.medium").alias("traffic_medium"),
            F.col("traffic_source.name").alias("traffic_campaign"),
            F.col("ecommerce.transaction_id").alias("transaction_id"),
            F.col("ecommerce.purchase_revenue").alias("purchase_revenue"),
            "event_timestamp",
        )
        .orderBy("event_timestamp", "event_name", "user_pseudo_id")
        .limit(n)
        .drop("event_timestamp")
    )


def item_field_sample(raw: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """The 10 item fields of the category check, first ``n`` item rows in
    event order."""
    items = raw.select(
        "event_date", "event_timestamp", "event_name", "user_pseudo_id", F.explode("items").alias("item")
    )
    return (
        items.select(
            "event_date",
            F.timestamp_micros("event_timestamp").alias("event_time"),
            "event_name",
            "user_pseudo_id",
            F.col("item.item_id").alias("item_id"),
            F.col("item.item_name").alias("item_name"),
            F.col("item.item_category").alias("item_category"),
            F.col("item.price").alias("price"),
            F.col("item.quantity").alias("quantity"),
            F.col("item.item_revenue").alias("item_revenue"),
            "event_timestamp",
        )
        .orderBy("event_timestamp", "item_id", "event_name", "user_pseudo_id")
        .limit(n)
        .drop("event_timestamp")
    )


def event_param_lookup(stg_events: DataFrame) -> DataFrame:
    """Key lookups into the event parameter list, per event."""
    return stg_events.select(
        "event_timestamp", "event_name", "user_pseudo_id", "ga_session_id", "session_key", "page_location"
    )


def category_cleaning(stg_items: DataFrame) -> DataFrame:
    """Raw -> cleaned category for every item row."""
    return stg_items.select(
        "event_timestamp", "session_key", "item_id", "raw_item_category", "cleaned_item_category"
    )


def windowed_events(stg_events: DataFrame) -> DataFrame:
    """Events and sessions per day and event name (of a window, if the staging
    layer has one)."""
    return stg_events.groupBy("event_date", "event_name").agg(
        F.count(F.lit(1)).alias("event_count"), F.countDistinct("session_key").alias("sessions")
    )
