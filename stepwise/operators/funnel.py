"""Strictly ordered conversion funnel.

Semantics (per key): ``t1`` = earliest step-1 event; ``t_i`` = earliest step-i
event with time >= ``t_{i-1}`` (inclusive, so one timestamp can satisfy
every step); a null ``t_i`` nulls every later step; keys without a step-1
event are absent; other event names are ignored; no time limit between
steps.

Physical shape, chosen for skewed keys at scale:

1. one aggregate over the step-1 events gives ``t1``. It is partially
   aggregated map side, so the bulk step-1 rows (product views) never cross
   the network one by one and a hot key costs one row per map task;
2. each later step's events are joined to the previous step's
   one-row-per-key time with ``split_join`` (adaptive execution splits hot
   keys), filtered by ``time >= previous`` and reduced with ``min`` (again
   with partial aggregation). The reduced step has an exchange of its own, so
   the next step and the result share one computation of it: a funnel of n
   steps runs n - 1 joins;
3. the per-step results (at most one row per key each) are stacked and
   pivoted back to one row per entry key with one union + aggregate.

Building a funnel starts no job. Keys and times are the only columns that
travel, all aggregates are hash aggregates, and no window buffers a whole key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepwise.operators.skew import split_join

PREV = "_prev"
T = "_t"
STEP = "_step"


def step_time_column(step: str) -> str:
    return f"{step}_time"


def _not_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def ordered_funnel(
    events: DataFrame,
    keys: list[str],
    steps: list[str],
    *,
    time_col: str = "event_time",
    event_col: str = "event_name",
) -> DataFrame:
    """One row per key that reached ``steps[0]``: ``keys``, then
    ``<step>_time`` for every step. Columns that a key determines (a session's
    user) belong in ``keys``; rows with a null in any of them are left out."""
    keys = list(keys)
    if len(steps) < 1:
        raise ValueError("a funnel needs at least one step")
    if len(set(steps)) != len(steps):
        # Each step is an event name and names its output column.
        raise ValueError(f"funnel steps must be distinct event names: {steps}")
    names = [step_time_column(s) for s in steps]

    def at_step(step: str) -> DataFrame:
        # The step's filter stands at the source, so it reaches the scan.
        rows = events.where((F.col(event_col) == F.lit(step)) & _not_null(keys))
        return rows.select(*keys, F.col(time_col).alias(T))

    reached = at_step(steps[0]).groupBy(*keys).agg(F.min(T).alias(T))
    if len(steps) == 1:
        return reached.withColumnRenamed(T, names[0])
    stacked = reached.withColumn(STEP, F.lit(0))
    for i, step in enumerate(steps[1:], start=1):
        reached = (
            split_join(at_step(step), reached.withColumnRenamed(T, PREV), keys)
            .where(F.col(T) >= F.col(PREV))
            .groupBy(*keys)
            .agg(F.min(T).alias(T))
        )
        stacked = stacked.unionByName(reached.withColumn(STEP, F.lit(i)))
    return stacked.groupBy(*keys).agg(
        *[F.max(F.when(F.col(STEP) == i, F.col(T))).alias(n) for i, n in enumerate(names)]
    )
