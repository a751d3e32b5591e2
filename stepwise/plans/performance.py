"""Category performance and channel x device performance.

Both group a one-row-per-unit funnel table by a low-cardinality label
(7 categories; channel x device). Such groups are hot by nature, so every
aggregate here is algebraic (sum/count with map-side partial aggregation)
except the distinct user count, which Spark plans as a two-level
aggregation keyed by (label, user): the per-label work is spread over the
users' hash, not gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepwise.functions.columns import (
    HIGH_VOLUME_SESSIONS,
    LOW_CONFIDENCE_CATEGORIES,
    exact_sum,
    safe_divide,
)
from stepwise.plans.funnels import MAIN_STEPS, SESSION

STEP_SUMS = [
    "viewed_item_sessions",
    "added_to_cart_sessions",
    "began_checkout_sessions",
    "purchased_sessions",
]
# Transition prefixes of the rate/drop-off columns, in step order.
TRANSITIONS = ["view_to_cart", "cart_to_checkout", "checkout_to_purchase"]


def _rate_block() -> list[Column]:
    """Step rates, overall rate, drop-off counts and drop-off rates over the
    four ``*_sessions`` sums."""
    s = [F.col(c) for c in STEP_SUMS]
    rates = [safe_divide(s[i + 1], s[i]).alias(f"{TRANSITIONS[i]}_rate") for i in range(3)]
    overall = safe_divide(s[3], s[0]).alias("view_to_purchase_rate")
    drops = [(s[i] - s[i + 1]).alias(f"{TRANSITIONS[i]}_dropoff_count") for i in range(3)]
    drop_rates = [
        (F.lit(1) - safe_divide(s[i + 1], s[i])).alias(f"{TRANSITIONS[i]}_dropoff_rate") for i in range(3)
    ]
    return [*rates, overall, *drops, *drop_rates]


def _step_sums() -> list[Column]:
    flags = ["viewed_item", "added_to_cart", "began_checkout", "purchased"]
    return [F.sum(f).cast("long").alias(n) for f, n in zip(flags, STEP_SUMS)]


# ---------------------------------------------------------------- category --
def category_events(stg_items: DataFrame) -> DataFrame:
    return stg_items.where(
        F.col("event_name").isin(MAIN_STEPS)
        & F.col("session_key").isNotNull()
        & F.col("cleaned_item_category").isNotNull()
    )


def category_revenue(stg_items: DataFrame) -> DataFrame:
    """Item revenue of every purchase item row with a session, by category
    (not limited to sessions that completed the ordered funnel, not
    deduplicated by transaction, as in the study)."""
    purchases = category_events(stg_items).where(F.col("event_name") == "purchase")
    value = F.coalesce(F.col("item_revenue"), F.col("price") * F.col("quantity"), F.lit(0.0))
    return purchases.groupBy("cleaned_item_category").agg(
        exact_sum(value).alias("total_item_revenue"),
        F.count(F.lit(1)).alias("purchased_item_rows"),
    )


def category_summary(category_funnel: DataFrame) -> DataFrame:
    """Per category: sessions (the funnel table is unique per (session,
    category), so a row count is the distinct session count), distinct
    users and the four step sums."""
    return category_funnel.groupBy("cleaned_item_category").agg(
        F.count(F.lit(1)).alias("category_view_sessions"),
        F.countDistinct("user_pseudo_id").alias("category_view_users"),
        *_step_sums(),
    )


def category_performance(
    summary: DataFrame, revenue: DataFrame, high_volume: int = HIGH_VOLUME_SESSIONS
) -> DataFrame:
    """22-column category mart; ``high_volume``: sessions from which a category
    counts as a large one. ``revenue`` has one row per cleaned category
    (at most the seven labels of the category rules), so it is broadcast."""
    df = summary.join(F.broadcast(revenue), "cleaned_item_category", "left")
    total = F.coalesce(F.col("total_item_revenue"), F.lit(0.0))
    return df.select(
        "cleaned_item_category",
        "category_view_sessions",
        "category_view_users",
        *STEP_SUMS,
        *_rate_block(),
        total.alias("total_item_revenue"),
        F.coalesce(F.col("purchased_item_rows"), F.lit(0).cast("long")).alias("purchased_item_rows"),
        safe_divide(total, "purchased_sessions").alias("revenue_per_purchasing_session"),
        (F.col("viewed_item_sessions") >= high_volume).alias("is_high_volume_category"),
        F.col("cleaned_item_category").isin(LOW_CONFIDENCE_CATEGORIES).alias("is_low_confidence_category"),
    )


# ---------------------------------------------------------------- segments --
def session_segments(stg_events: DataFrame) -> DataFrame:
    """One (traffic_channel, device_category) per session with a product
    view: the attributes of its earliest view_item event (ties: channel,
    then device, ascending).

    The views are first reduced to the earliest time of each combination that
    a session has (a hash aggregate with partial aggregation); the minimum of
    the ordered struct then sees those few rows only."""
    segment = ["traffic_channel", "device_category"]
    earliest = (
        stg_events.where((F.col("event_name") == "view_item") & F.col("session_key").isNotNull())
        .groupBy(*SESSION, *segment)
        .agg(F.min("event_time").alias("_time"))
    )
    first = earliest.groupBy(*SESSION).agg(F.min(F.struct("_time", *segment)).alias("_first"))
    return first.select("session_key", *[F.col(f"_first.{c}").alias(c) for c in segment])


def session_funnel_segmented(session_steps: DataFrame, segments: DataFrame) -> DataFrame:
    """The session funnel with each session's segment. Both sides have one row
    per session, and every session of the funnel has a segment."""
    return session_steps.join(segments, "session_key")


def segment_summary(segmented_sessions: DataFrame) -> DataFrame:
    """Per (traffic_channel, device_category): sessions, distinct users and
    the four step sums; each session counted in exactly one segment."""
    return segmented_sessions.groupBy("traffic_channel", "device_category").agg(
        F.count(F.lit(1)).alias("sessions_entered_funnel"),
        F.countDistinct("user_pseudo_id").alias("unique_users"),
        *_step_sums(),
    )


def channel_device_performance(segmented_sessions: DataFrame) -> DataFrame:
    """19-column mart: one row per (traffic_channel, device_category)."""
    return channel_device_metrics(segment_summary(segmented_sessions))


def channel_device_metrics(agg: DataFrame) -> DataFrame:
    """Rates, drop-offs and the volume flag over ``segment_summary`` rows
    (accepts pre-counted rows)."""
    return agg.select(
        "traffic_channel",
        "device_category",
        "sessions_entered_funnel",
        "unique_users",
        *STEP_SUMS,
        *_rate_block(),
        (F.col("viewed_item_sessions") >= HIGH_VOLUME_SESSIONS).alias("is_high_volume_segment"),
    )
