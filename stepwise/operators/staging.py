"""Staging: raw nested events -> flat event rows and flat item rows.

Both are narrow projections (plus a generator for items): no shuffle. The
session id is looked up once per row and reused for the session key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepwise.functions.columns import (
    clean_category,
    param_int,
    param_str,
    session_key,
    traffic_channel,
)
from stepwise.sources.ga4 import apply_window

STG_EVENTS_COLUMNS = [
    "event_date",
    "event_time",
    "event_timestamp",
    "event_name",
    "user_pseudo_id",
    "ga_session_id",
    "session_key",
    "page_location",
    "platform",
    "device_category",
    "traffic_source",
    "traffic_medium",
    "traffic_campaign",
    "traffic_channel",
    "transaction_id",
    "purchase_revenue",
]

STG_ITEMS_COLUMNS = [
    "event_date",
    "event_time",
    "event_timestamp",
    "event_name",
    "user_pseudo_id",
    "ga_session_id",
    "session_key",
    "item_id",
    "item_name",
    "item_brand",
    "raw_item_category",
    "price",
    "quantity",
    "item_revenue",
    "cleaned_item_category",
]


def _event_header(raw: DataFrame) -> DataFrame:
    """Columns shared by the two staging tables; ``ga_session_id`` is
    computed once and the session key is derived from it."""
    return raw.withColumn("ga_session_id", param_int("event_params", "ga_session_id")).withColumn(
        "session_key", session_key("user_pseudo_id", "ga_session_id")
    )


def stg_events(raw: DataFrame, window: tuple[str, str] | None = None) -> DataFrame:
    """One row per event with flattened fields and the traffic channel."""
    df = _event_header(apply_window(raw, window))
    src = F.lower("traffic_source.source")
    med = F.lower("traffic_source.medium")
    return df.select(
        F.to_date("event_date", "yyyyMMdd").alias("event_date"),
        F.timestamp_micros("event_timestamp").alias("event_time"),
        "event_timestamp",
        "event_name",
        "user_pseudo_id",
        "ga_session_id",
        "session_key",
        param_str("event_params", "page_location").alias("page_location"),
        "platform",
        F.lower("device.category").alias("device_category"),
        src.alias("traffic_source"),
        med.alias("traffic_medium"),
        F.lower("traffic_source.name").alias("traffic_campaign"),
        traffic_channel(src, med).alias("traffic_channel"),
        F.col("ecommerce.transaction_id").alias("transaction_id"),
        F.col("ecommerce.purchase_revenue").alias("purchase_revenue"),
    )


def stg_items(raw: DataFrame, window: tuple[str, str] | None = None) -> DataFrame:
    """One row per item inside an event (inner unnest: events with a null or
    empty item list produce no rows)."""
    df = _event_header(apply_window(raw, window))
    exploded = df.select(
        "event_date",
        "event_timestamp",
        "event_name",
        "user_pseudo_id",
        "ga_session_id",
        "session_key",
        F.explode("items").alias("item"),
    )
    return exploded.select(
        F.to_date("event_date", "yyyyMMdd").alias("event_date"),
        F.timestamp_micros("event_timestamp").alias("event_time"),
        "event_timestamp",
        "event_name",
        "user_pseudo_id",
        "ga_session_id",
        "session_key",
        F.col("item.item_id").alias("item_id"),
        F.col("item.item_name").alias("item_name"),
        F.col("item.item_brand").alias("item_brand"),
        F.col("item.item_category").alias("raw_item_category"),
        F.col("item.price").alias("price"),
        F.col("item.quantity").alias("quantity"),
        F.col("item.item_revenue").alias("item_revenue"),
        clean_category("item.item_category").alias("cleaned_item_category"),
    )
