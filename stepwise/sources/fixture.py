"""Adapter: the driver's flat ``events`` table -> raw nested event records.

The driver ships ``events(event_id, ts, user_id, event_type, value, props)``
instead of raw nested exports, so every query reads it through this mapping
(all rules are integer arithmetic on the row, so the same mapping can be
written in plain SQL for the DuckDB oracle). It is a narrow projection: no
shuffle, no Python, one pass per scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepwise.sources.schema import EVENT_SCHEMA

# Fixed values of the mapping (FIXTURES section B).
# Traffic (source, medium) pairs, picked by index 0..7.
TRAFFIC_PAIRS = [
    ("google", "organic"),
    ("Google", "CPC"),
    ("(direct)", "(none)"),
    ("shop.example", "referral"),
    ("(data deleted)", "(data deleted)"),
    ("<Other>", "<Other>"),
    (None, None),
    ("google", None),
]
# Device category by user_id % 3 (mixed case on purpose).
DEVICES = ["Desktop", "mobile", "Tablet"]
# Item category text by (user_id + i) % 10.
ITEM_CATEGORIES = [
    "Home/Apparel",
    "Womens",
    "Drinkware",
    "Bags",
    "Office/Stationery",
    "Shop Sale",
    "Writing Instruments",
    None,
    "  ",
    "(not set)",
]
CAMPAIGN = "(fixture)"
PAGE_PREFIX = "https://shop.example/user/"
SESSION_EPOCH = "2024-01-01"


def _pick(index: Column, values: list, dtype: str = "string") -> Column:
    """``values[index]`` (0-based; null entries stay null): one array lookup
    instead of a CASE chain, which keeps the plan small."""
    arr = F.array(*[F.lit(v).cast(dtype) for v in values])
    return F.get(arr, index.cast("int"))


def _epoch_micros(ts: Column, dtype: T.DataType) -> Column:
    """Epoch microseconds of ``ts`` read as UTC wall time, independent of
    the session time zone."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff(
            "MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts
        )
    return F.unix_micros(ts)


def ga4_from_events(events: DataFrame) -> DataFrame:
    """Map the flat test table onto ``EVENT_SCHEMA`` (same column order and
    leaf types). A single narrow projection; every rule is written once."""
    ts_type = events.schema["ts"].dataType
    eid, uid, etype, value = F.col("event_id"), F.col("user_id"), F.col("event_type"), F.col("value")
    k = F.get_json_object("props", "$.k").cast("int")
    # Dates come from epoch microseconds (UTC), never from the session time
    # zone: the same rows whatever the reading session is configured with.
    micros = _epoch_micros(F.col("ts"), ts_type)
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(micros / F.lit(86_400_000_000)).cast("int"))

    event_name = (
        F.when(etype == "view", "view_item")
        .when(etype == "click", F.when(uid % 7 == 0, "page_view").otherwise("add_to_cart"))
        .when(etype == "signup", F.when(uid % 5 == 0, "page_view").otherwise("begin_checkout"))
        .when(etype == "purchase", F.when(uid % 4 == 3, "page_view").otherwise("purchase"))
        .when(etype == "error", F.when(k % 2 == 0, "add_shipping_info").otherwise("add_payment_info"))
    )
    session_id = F.floor(F.datediff(day, F.lit(SESSION_EPOCH).cast("date")) / 7).cast("long")
    no_string, no_int = F.lit(None).cast("string"), F.lit(None).cast("long")
    params = F.array(
        F.struct(
            F.lit("page_location").alias("key"),
            F.struct(F.concat(F.lit(PAGE_PREFIX), uid.cast("string")).alias("string_value"), no_int.alias("int_value")).alias("value"),
        ),
        F.struct(
            F.lit("ga_session_id").alias("key"),
            F.struct(no_string.alias("string_value"), session_id.alias("int_value")).alias("value"),
        ),
    )
    # The session id key is left out for every 101st event.
    params = F.slice(params, 1, F.when(eid % 101 == 0, 1).otherwise(2))

    tidx = (uid + F.when(eid % 10 == 0, 1).otherwise(0)) % 8
    traffic = F.struct(
        _pick(tidx, [p[0] for p in TRAFFIC_PAIRS]).alias("source"),
        _pick(tidx, [p[1] for p in TRAFFIC_PAIRS]).alias("medium"),
        F.lit(CAMPAIGN).alias("name"),
    )
    is_purchase = etype == "purchase"
    ecommerce = F.when(
        is_purchase,
        F.struct(
            F.when(eid % 13 != 0, F.concat(F.lit("T"), F.expr("event_id div 5").cast("string"))).alias(
                "transaction_id"
            ),
            F.when(eid % 11 != 0, value).alias("purchase_revenue"),
        ),
    )
    quantity = F.when(eid % 17 != 0, (1 + k % 3).cast("long"))
    item_revenue = F.when(is_purchase & (eid % 7 != 0), value * quantity)

    def item(i: Column) -> Column:
        slot = (uid + i) % 10
        return F.struct(
            F.concat(F.lit("SKU-"), slot.cast("string")).alias("item_id"),
            F.concat(F.lit("Item "), slot.cast("string")).alias("item_name"),
            F.lit("Shop").alias("item_brand"),
            _pick(slot, ITEM_CATEGORIES).alias("item_category"),
            value.alias("price"),
            quantity.alias("quantity"),
            item_revenue.alias("item_revenue"),
        )

    # k % 3 items (0, 1 or 2); entry i uses slot (user_id + i) % 10.
    items = F.transform(F.slice(F.array(F.lit(0), F.lit(1)), 1, k % 3), item)
    return events.select(
        F.date_format(day, "yyyyMMdd").alias("event_date"),
        micros.alias("event_timestamp"),
        event_name.alias("event_name"),
        F.when(eid % 103 != 0, uid.cast("string")).alias("user_pseudo_id"),
        params.alias("event_params"),
        F.lit("WEB").alias("platform"),
        F.struct(_pick(uid % 3, DEVICES).alias("category")).alias("device"),
        traffic.alias("traffic_source"),
        ecommerce.alias("ecommerce"),
        items.alias("items"),
    )


def load_events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def load_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw nested events derived from ``{sf_dir}/events.parquet``."""
    return ga4_from_events(load_events_table(spark, sf_dir))
