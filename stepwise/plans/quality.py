"""Data-quality checks as result rows (8 checks).

Each check is a global ``count_if`` over a mart (map-side partial
aggregation); checks over the same table share one aggregate, so every
input is scanned once and the union is 8 rows whatever the input size.
``check_value`` counts violations, except for the two "available" checks,
which count what is there and pass when it is positive.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stepwise.plans.profile import KEY_FUNNEL_EVENTS

PASS, FAIL = "PASS", "FAIL"

# Check names, areas and descriptions.
CHECKS = {
    "reliable_categories_available": (
        "category_performance",
        "Category performance should include at least one reliable product category.",
    ),
    "friction_scores_between_0_and_100": (
        "friction_score",
        "Friction scores should stay between 0 and 100 for dashboard interpretation.",
    ),
    "funnel_counts_do_not_increase": (
        "funnel_summary",
        "Each funnel step should have less than or equal to the previous step count.",
    ),
    "funnel_rates_between_0_and_1": (
        "funnel_summary",
        "Funnel conversion and drop-off rates should stay within valid percentage bounds.",
    ),
    "estimated_leakage_not_negative": (
        "revenue_leakage",
        "Estimated revenue leakage should never be negative.",
    ),
    "revenue_baseline_valid": (
        "revenue_leakage",
        "Revenue leakage requires positive transaction count, revenue, and average order value.",
    ),
    "key_funnel_events_no_null_sessions": (
        "staging",
        "Key funnel events should have valid session keys for session-level analysis.",
    ),
    "stg_events_not_empty": ("staging", "stg_events should contain event-level GA4 data."),
}


def _rows(names: list[tuple[str, bool]], value: Callable[[int], Column]) -> Column:
    """An array of result rows; ``value(i)`` is the value of the i-th check."""
    rows = []
    for i, (name, positive) in enumerate(names):
        area, description = CHECKS[name]
        v = value(i)
        ok = (v > 0) if positive else (v == 0)
        rows.append(
            F.struct(
                F.lit(name).alias("check_name"),
                F.lit(area).alias("check_area"),
                v.alias("check_value"),
                F.when(ok, PASS).otherwise(FAIL).alias("check_status"),
                F.lit(description).alias("check_description"),
            )
        )
    return F.array(*rows)


def _checks(df: DataFrame, specs: list[tuple[str, Column, bool]]) -> DataFrame:
    """All checks over one table in ONE aggregate (one pass, one copy of
    the table's plan), then one row per check.

    ``specs``: (check name, aggregate value, pass when positive).
    """
    values = df.agg(*metrics(specs))
    return values.select(F.inline(_rows([(name, some) for name, _, some in specs], lambda i: F.col(f"_v{i}"))))


def metrics(specs: list[tuple[str, Column, bool]]) -> list[Column]:
    """The values of checks as aggregates ``_v0``, ``_v1``, ..."""
    return [F.coalesce(v.cast("long"), F.lit(0).cast("long")).alias(f"_v{i}") for i, (_, v, _) in enumerate(specs)]


def _outside(c: str, lo: float, hi: float) -> Column:
    col = F.col(c)
    return F.coalesce((col < lo) | (col > hi), F.lit(False))


def _not_positive(c: str) -> Column:
    col = F.col(c)
    return col.isNull() | (col <= 0)


def specs() -> dict[str, list[tuple[str, Column, bool]]]:
    """Layer -> its checks: (check name, aggregate value, pass when positive)."""
    key_event = F.col("event_name").isin(KEY_FUNNEL_EVENTS)
    return {
        "category_performance": [
            ("reliable_categories_available", F.count_if(~F.col("is_low_confidence_category")), True),
        ],
        "friction_score": [
            (
                "friction_scores_between_0_and_100",
                F.count_if(F.col("friction_score").isNull() | _outside("friction_score", 0, 100)),
                False,
            )
        ],
        "funnel_summary": [
            (
                "funnel_counts_do_not_increase",
                F.count_if(
                    (F.col("step_order") > 1)
                    & F.coalesce(F.col("reached_count") > F.col("previous_step_count"), F.lit(False))
                ),
                False,
            ),
            (
                "funnel_rates_between_0_and_1",
                F.count_if(
                    _outside("step_conversion_rate", 0, 1)
                    | _outside("overall_conversion_rate", 0, 1)
                    | _outside("dropoff_rate", 0, 1)
                ),
                False,
            ),
        ],
        "revenue_leakage": [
            (
                "estimated_leakage_not_negative",
                F.count_if(F.coalesce(F.col("estimated_revenue_leakage") < 0, F.lit(False))),
                False,
            ),
            (
                "revenue_baseline_valid",
                F.count_if(
                    _not_positive("unique_transactions")
                    | _not_positive("total_purchase_revenue")
                    | _not_positive("average_order_value")
                ),
                False,
            ),
        ],
        "stg_events": [
            ("key_funnel_events_no_null_sessions", F.count_if(key_event & F.col("session_key").isNull()), False),
            ("stg_events_not_empty", F.count(F.lit(1)), True),
        ],
    }


def data_quality_checks(
    category_performance: DataFrame,
    friction: DataFrame,
    summary: DataFrame,
    leakage: DataFrame,
    stg_events: DataFrame,
) -> DataFrame:
    layers = (category_performance, friction, summary, leakage, stg_events)
    out = reduce(DataFrame.union, [_checks(df, own) for df, own in zip(layers, specs().values())])
    return out.orderBy("check_area", "check_name")


class Observed:
    """Checks whose values are observed while their layers are written.

    ``watch`` attaches a layer's checks to the frame that is written anyway;
    once all layers are written, ``result`` has the rows of
    ``data_quality_checks`` without a second read of any of them. A layer must be
    written once, and its frame must reach the writer as it is (what is between
    ``watch`` and the write must not drop or repeat rows)."""

    def __init__(self) -> None:
        self.specs = specs()
        self.seen: dict[str, Observation] = {}

    def watch(self, layer: str, df: DataFrame) -> DataFrame:
        """``df`` as it is, observed if ``layer`` has checks."""
        if layer not in self.specs:
            return df
        if layer in self.seen:
            raise ValueError(f"{layer} is watched already")
        self.seen[layer] = Observation(f"checks of {layer}")
        return df.observe(self.seen[layer], *metrics(self.specs[layer]))

    def result(self, spark: SparkSession) -> DataFrame:
        missing = sorted(set(self.specs) - set(self.seen))
        if missing:
            raise ValueError(f"not written yet: {missing}")
        found = [(name, some, self.seen[layer].get[f"_v{i}"]) for layer, own in self.specs.items() for i, (name, _, some) in enumerate(own)]
        # One row per check.
        rows = _rows([(name, some) for name, some, _ in found], lambda i: F.lit(found[i][2]).cast("long"))
        return spark.range(1).select(F.inline(rows)).orderBy("check_area", "check_name")
