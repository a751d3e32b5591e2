"""Transaction-deduplicated revenue baseline, revenue leakage, friction score.

The baseline is one row (a global aggregate over one row per transaction),
so it is attached to the transitions as one scalar subquery, not a join. The leakage
and friction tables have one row per funnel transition (9 with the standard
funnels): their global ranks and max run over a size fixed by the funnel
definitions, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stepwise.functions.columns import (
    DROPOFF_WEIGHT,
    LEAKAGE_TIER_DEFAULT,
    LEAKAGE_TIERS,
    LEAKAGE_WEIGHT,
    exact_sum,
    friction_priority,
    likely_business_issue,
    recommended_investigation,
    safe_divide,
    tier,
)

LEAKAGE_COLUMNS = [
    "funnel_type",
    "unit_type",
    "step_order",
    "previous_funnel_step",
    "current_funnel_step",
    "funnel_transition",
    "previous_step_count",
    "reached_count",
    "dropoff_count",
    "dropoff_rate",
    "step_conversion_rate",
    "overall_conversion_rate",
    "unique_transactions",
    "total_purchase_revenue",
    "average_order_value",
    "estimated_revenue_leakage",
    "leakage_rank_within_funnel",
    "overall_leakage_rank",
    "leakage_priority",
]

# Transition columns carried into the leakage table, in output order.
TRANSITION_LEAKAGE_COLUMNS = LEAKAGE_COLUMNS[:12]

FRICTION_COLUMNS = [
    "funnel_type",
    "unit_type",
    "step_order",
    "previous_funnel_step",
    "current_funnel_step",
    "funnel_transition",
    "previous_step_count",
    "reached_count",
    "dropoff_count",
    "dropoff_rate",
    "step_conversion_rate",
    "overall_conversion_rate",
    "average_order_value",
    "estimated_revenue_leakage",
    "normalized_revenue_leakage",
    "friction_score",
    "overall_friction_rank",
    "friction_rank_within_funnel",
    "friction_priority",
    "likely_business_issue",
    "recommended_investigation",
]


def transaction_revenue(stg_events: DataFrame) -> DataFrame:
    """One row per transaction id among purchases that carry an id and a
    revenue; the maximum revenue of its (possibly repeated) events.
    Placeholder ids are kept, as in the study."""
    return (
        stg_events.where(
            (F.col("event_name") == "purchase")
            & F.col("transaction_id").isNotNull()
            & F.col("purchase_revenue").isNotNull()
        )
        .groupBy("transaction_id")
        .agg(F.max("purchase_revenue").alias("transaction_revenue"))
    )


def revenue_baseline(transactions: DataFrame) -> DataFrame:
    """unique_transactions, total_purchase_revenue, average_order_value.

    The sum is exact (decimal accumulation) and divided once, so the average
    does not depend on row order; empty input gives 0 / null / null.
    """
    total = exact_sum("transaction_revenue")
    return transactions.agg(
        F.count(F.lit(1)).alias("unique_transactions"),
        total.alias("total_purchase_revenue"),
        safe_divide(total, F.count(F.lit(1))).alias("average_order_value"),
    )


def revenue_leakage(
    transitions: DataFrame, baseline: DataFrame, tiers: list[tuple[float, str]] = LEAKAGE_TIERS
) -> DataFrame:
    """``dropoff_count * average_order_value`` per transition (step > 1),
    dense-ranked within each funnel and overall, and tiered."""
    # The baseline is exactly one row (a global aggregate): one scalar
    # subquery, a struct of its columns, instead of a join of every transition.
    columns = ("unique_transactions", "total_purchase_revenue", "average_order_value")
    base = baseline.select(F.struct(*columns)).scalar()
    t = transitions.where(F.col("step_order") > 1).select(
        *TRANSITION_LEAKAGE_COLUMNS, *[base[c].alias(c) for c in columns]
    )
    leak = F.col("dropoff_count") * F.col("average_order_value")
    t = t.withColumn("estimated_revenue_leakage", leak)
    by_funnel = Window.partitionBy("funnel_type").orderBy(F.desc_nulls_last("estimated_revenue_leakage"))
    overall = Window.orderBy(F.desc_nulls_last("estimated_revenue_leakage"))
    return t.select(
        *LEAKAGE_COLUMNS[:16],
        F.dense_rank().over(by_funnel).cast("long").alias("leakage_rank_within_funnel"),
        F.dense_rank().over(overall).cast("long").alias("overall_leakage_rank"),
        tier("estimated_revenue_leakage", tiers, LEAKAGE_TIER_DEFAULT).alias("leakage_priority"),
    )


def friction_score(leakage: DataFrame) -> DataFrame:
    """``round(100 * (0.65 * leakage / max leakage + 0.35 * drop-off rate), 2)``,
    dense-ranked on the rounded score, tiered and annotated."""
    # MAX(..) OVER (): the table has one row per funnel transition (bounded
    # by the funnel definitions), so one window partition is the cheap plan
    # and avoids planning the leakage chain twice for a self-join.
    everything = Window.partitionBy()
    df = leakage.withColumn(
        "normalized_revenue_leakage",
        safe_divide("estimated_revenue_leakage", F.max("estimated_revenue_leakage").over(everything)),
    )
    score = F.round(
        (F.lit(LEAKAGE_WEIGHT) * F.col("normalized_revenue_leakage") + F.lit(DROPOFF_WEIGHT) * F.col("dropoff_rate"))
        * F.lit(100),
        2,
    )
    df = df.withColumn("friction_score", score)
    overall = Window.orderBy(F.desc_nulls_last("friction_score"))
    by_funnel = Window.partitionBy("funnel_type").orderBy(F.desc_nulls_last("friction_score"))
    return df.select(
        *FRICTION_COLUMNS[:16],
        F.dense_rank().over(overall).cast("long").alias("overall_friction_rank"),
        F.dense_rank().over(by_funnel).cast("long").alias("friction_rank_within_funnel"),
        friction_priority("friction_score").alias("friction_priority"),
        likely_business_issue("funnel_transition").alias("likely_business_issue"),
        recommended_investigation("funnel_transition").alias("recommended_investigation"),
    )
