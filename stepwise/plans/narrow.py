"""Narrow tables that several funnels of one query share.

A funnel reads its source once per step. Where a query builds several, the
columns they read are written once to the shared checkpoint folder, sorted by
event name within each file, so that the filter of a step skips row groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from stepwise.session import shared_dir

STEP_COLUMNS = [
    "event_name",
    "event_time",
    "user_pseudo_id",
    "session_key",
    "traffic_channel",
    "device_category",
    "transaction_id",
    "purchase_revenue",
]
ITEM_COLUMNS = [
    "event_name",
    "event_time",
    "user_pseudo_id",
    "session_key",
    "cleaned_item_category",
    "price",
    "quantity",
    "item_revenue",
]


def write_once(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder, and read back."""
    spark = df.sparkSession
    path = shared_dir(spark, tag)
    rows = df.sortWithinPartitions("event_name") if "event_name" in df.columns else df
    rows.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
