"""Funnel summary (12 rows) and funnel transitions.

Each funnel's step counts come from ONE aggregate of its flag columns (a
single pass over the step table instead of one scan per step), unpivoted to
one row per step. The window functions that follow run over at most
``3 funnels x 4 steps`` rows, a size fixed by the funnel definitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stepwise.functions.columns import ARROW, safe_divide
from stepwise.plans.funnels import CHECKOUT_FLAGS, MAIN_FLAGS

# Funnel names, units and step labels.
USER_FUNNEL = "User-Level Main Funnel"
SESSION_FUNNEL = "Session-Level Main Funnel"
CHECKOUT_FUNNEL = "Checkout Friction Funnel"
MAIN_LABELS = ["View Item", "Add to Cart", "Begin Checkout", "Purchase"]
CHECKOUT_LABELS = ["Begin Checkout", "Add Shipping Info", "Add Payment Info", "Purchase"]

COUNT_COLUMNS = ["funnel_type", "unit_type", "step_order", "funnel_step", "reached_count"]
SUMMARY_COLUMNS = [
    "funnel_type",
    "unit_type",
    "step_order",
    "funnel_step",
    "reached_count",
    "previous_step_count",
    "step_conversion_rate",
    "overall_conversion_rate",
    "dropoff_count",
    "dropoff_rate",
]
TRANSITION_COLUMNS = [
    "funnel_type",
    "unit_type",
    "step_order",
    "previous_funnel_step",
    "current_funnel_step",
    "funnel_transition",
    "reached_count",
    "previous_step_count",
    "dropoff_count",
    "dropoff_rate",
    "step_conversion_rate",
    "overall_conversion_rate",
]


def step_counts(
    steps: DataFrame, funnel_type: str, unit_type: str, flags: list[str], labels: list[str]
) -> DataFrame:
    """Sum every flag in one aggregate, then one row per step (sum over an
    empty table is null, as in SQL)."""
    sums = steps.agg(*[F.sum(f).cast("long").alias(f"_s{i}") for i, f in enumerate(flags)])
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("step_order"),
                F.lit(label).alias("funnel_step"),
                F.col(f"_s{i}").alias("reached_count"),
            )
            for i, label in enumerate(labels)
        ]
    )
    return sums.select(
        F.lit(funnel_type).alias("funnel_type"),
        F.lit(unit_type).alias("unit_type"),
        F.inline(rows),
    )


def funnel_counts(user_steps: DataFrame, session_steps: DataFrame, checkout_steps: DataFrame) -> DataFrame:
    # Positional union: step_counts always yields COUNT_COLUMNS in order.
    return (
        step_counts(user_steps, USER_FUNNEL, "Users", MAIN_FLAGS, MAIN_LABELS)
        .union(step_counts(session_steps, SESSION_FUNNEL, "Sessions", MAIN_FLAGS, MAIN_LABELS))
        .union(step_counts(checkout_steps, CHECKOUT_FUNNEL, "Sessions", CHECKOUT_FLAGS, CHECKOUT_LABELS))
    )


def funnel_summary(counts: DataFrame) -> DataFrame:
    """Previous/first step counts, conversion and drop-off per step.

    ``counts`` has ``COUNT_COLUMNS``; accepting pre-counted rows lets the
    published step counts be replayed through the same code.
    """
    w = Window.partitionBy("funnel_type").orderBy("step_order")
    first_step = F.col("step_order") == 1
    reached, prev = F.col("reached_count"), F.col("previous_step_count")
    df = counts.withColumn("previous_step_count", F.lag("reached_count").over(w)).withColumn(
        "_first_step_count", F.first("reached_count").over(w)
    )
    return df.select(
        "funnel_type",
        "unit_type",
        "step_order",
        "funnel_step",
        "reached_count",
        "previous_step_count",
        F.when(first_step, F.lit(1.0)).otherwise(safe_divide(reached, prev)).alias("step_conversion_rate"),
        safe_divide(reached, F.col("_first_step_count")).alias("overall_conversion_rate"),
        F.when(first_step, F.lit(0).cast("long")).otherwise(prev - reached).alias("dropoff_count"),
        F.when(first_step, F.lit(0.0)).otherwise(F.lit(1) - safe_divide(reached, prev)).alias("dropoff_rate"),
    ).orderBy("funnel_type", "step_order")


def funnel_transitions(summary: DataFrame) -> DataFrame:
    """Adds the previous step's name and the ``A → B`` label to every row."""
    w = Window.partitionBy("funnel_type").orderBy("step_order")
    df = summary.withColumn("previous_funnel_step", F.lag("funnel_step").over(w))
    return df.select(
        "funnel_type",
        "unit_type",
        "step_order",
        "previous_funnel_step",
        F.col("funnel_step").alias("current_funnel_step"),
        F.concat(F.col("previous_funnel_step"), F.lit(ARROW), F.col("funnel_step")).alias(
            "funnel_transition"
        ),
        "reached_count",
        "previous_step_count",
        "dropoff_count",
        "dropoff_rate",
        "step_conversion_rate",
        "overall_conversion_rate",
    )
