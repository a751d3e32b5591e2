"""The four ordered funnels of the study, as step tables.

* user funnel:      key user,                steps view -> cart -> checkout -> purchase
* session funnel:   key session,             same steps (actions inside one visit)
* checkout funnel:  key session,             checkout -> shipping -> payment -> purchase
* category funnel:  key (session, category), same steps as the main funnel, over item rows
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepwise.functions.columns import flag, funnel_status
from stepwise.operators.funnel import step_time_column
from stepwise.operators.transitions import transition_funnel

# Event names of the two funnels, in step order.
MAIN_STEPS = ["view_item", "add_to_cart", "begin_checkout", "purchase"]
CHECKOUT_STEPS = ["begin_checkout", "add_shipping_info", "add_payment_info", "purchase"]
# Flag column per step event.
MAIN_FLAGS = ["viewed_item", "added_to_cart", "began_checkout", "purchased"]
CHECKOUT_FLAGS = ["began_checkout", "added_shipping_info", "added_payment_info", "purchased"]


def _main_outputs(df: DataFrame, id_cols: list[str]) -> DataFrame:
    view, cart, checkout, purchase = (F.col(step_time_column(s)) for s in MAIN_STEPS)
    return df.select(
        *id_cols,
        *[step_time_column(s) for s in MAIN_STEPS],
        F.lit(1).alias("viewed_item"),
        flag(cart).alias("added_to_cart"),
        flag(checkout).alias("began_checkout"),
        flag(purchase).alias("purchased"),
        F.when(purchase.isNotNull(), F.timestamp_diff("MINUTE", view, purchase)).alias(
            "minutes_from_view_to_purchase"
        ),
        funnel_status(cart, checkout, purchase).alias("final_funnel_status"),
    )


def user_funnel_steps(stg_events: DataFrame) -> DataFrame:
    """One row per user with at least one product view."""
    f = transition_funnel(stg_events, ["user_pseudo_id"], MAIN_STEPS)
    return _main_outputs(f, ["user_pseudo_id"])


# A session belongs to one user (its key is made of the user's id), so the
# user is part of the grouping, not an aggregate.
SESSION = ["session_key", "user_pseudo_id"]


def session_funnel_steps(stg_events: DataFrame) -> DataFrame:
    """One row per session with at least one product view; every step must
    happen inside the same session."""
    return _main_outputs(transition_funnel(stg_events, SESSION, MAIN_STEPS), SESSION)


def checkout_funnel_steps(stg_events: DataFrame) -> DataFrame:
    """One row per session that began checkout (any such session, not only
    those that viewed an item first)."""
    f = transition_funnel(stg_events, SESSION, CHECKOUT_STEPS)
    times = [F.col(step_time_column(s)) for s in CHECKOUT_STEPS]
    return f.select(
        "session_key",
        "user_pseudo_id",
        *[step_time_column(s) for s in CHECKOUT_STEPS],
        F.lit(1).alias(CHECKOUT_FLAGS[0]),
        *[flag(t).alias(n) for t, n in zip(times[1:], CHECKOUT_FLAGS[1:])],
    )


def category_session_funnel(stg_items: DataFrame) -> DataFrame:
    """One row per (session, cleaned category) with a product view of that
    category; later steps must involve an item of the same category."""
    f = transition_funnel(stg_items, [*SESSION, "cleaned_item_category"], MAIN_STEPS)
    t = [F.col(step_time_column(s)) for s in MAIN_STEPS]
    return f.select(
        "session_key",
        "user_pseudo_id",
        "cleaned_item_category",
        F.lit(1).alias("viewed_item"),
        flag(t[1]).alias("added_to_cart"),
        flag(t[2]).alias("began_checkout"),
        flag(t[3]).alias("purchased"),
    )


def user_funnel_status(user_steps: DataFrame) -> DataFrame:
    """Distribution of the furthest-stage label over users."""
    return user_steps.groupBy("final_funnel_status").agg(F.count(F.lit(1)).alias("user_count"))
