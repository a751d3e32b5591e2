"""Strictly ordered conversion funnel in one scan, by transition tables.

Same semantics as ``operators.funnel`` (per key: the earliest first step, then
the earliest next step at or after the one before), but the events are read
once, whatever the number of steps, and no step waits for the one before it.

A *transition table* says, for a key and a range of time, what happens to a
unit that enters the range with i steps done: the times of the steps i+1, i+2,
... that it completes inside the range. Tables of neighbouring ranges compose
(what the first one leaves open, the second one continues), and composition is
associative, so tables are merged in the order of time at any granularity.

1. One hash aggregate over the scan reduces the events before anything is
   shuffled: of the first step only the earliest time per key and range counts
   (product views, the bulk, become one row per key, range and map task); of
   later steps each distinct time.
2. One row per (key, range) holds its transition table. A hot key is spread over
   as many groups as it has ranges, so no task sees more of it than one range.
3. The tables of a key are folded in the order of time; the rows of a key are
   bounded by the length of the data over the length of a range. Coarser
   ``ranges`` in between bound them further (minutes, then days).

Everything is a built-in aggregate or higher-order function; building a funnel
starts no job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepwise.operators.funnel import _not_null, step_time_column

#: Seconds of the ranges, finest first.
RANGES = (300,)

_RANGE, _STEP, _LATER, _TIME, _RUNS, _DONE = "_range", "_step", "_later", "_time", "_runs", "_done_in"


def _no_times(time_type: str) -> Column:
    return F.array().cast(f"array<{time_type}>")


def _table(steps: Column, n: int, time_type: str) -> Column:
    """The transition table of one range: entry i, the times of the steps that
    follow when i steps are done. ``steps``: an array of (nr, times)."""

    def following(done: Column, step: Column) -> Column:
        open_ = F.filter(step["times"], lambda t: (F.size(done) == 0) | (t >= F.element_at(done, -1)))
        return F.concat(done, F.array_compact(F.array(F.array_min(open_))))

    def entered(i: Column) -> Column:
        # A step counts if all steps since the entry are done: as many as its distance.
        return F.aggregate(
            steps, _no_times(time_type), lambda done, step: F.when(step["nr"] == i + F.size(done), following(done, step)).otherwise(done)
        )

    return F.transform(F.sequence(F.lit(0), F.lit(n)), entered)


def _by_step(done: Column, n: int) -> Column:
    """The (nr, time) of a range as an array of (nr, times) for all steps."""

    def at(i: Column) -> Column:
        times = F.transform(F.filter(done, lambda d: d["nr"] == i), lambda d: d["time"])
        return F.struct(i.alias("nr"), times.alias("times"))

    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), at)


def _single(step: Column, n: int, time_type: str) -> Column:
    """The table of a range with one step in it, as most ranges have."""
    return F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: F.when(i == step["nr"], F.array(step["time"])).otherwise(_no_times(time_type)))


def _composed(tables: Column, n: int, time_type: str) -> Column:
    """The table of the tables of neighbouring ranges, in the order of time."""
    return F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: _passed(tables, i, time_type))


def _passed(tables: Column, entry: Column, time_type: str) -> Column:
    """Times of the steps that a unit does from ``entry`` steps on."""
    return F.aggregate(
        tables, _no_times(time_type), lambda done, table: F.concat(done, F.get(table[_RUNS], entry + F.size(done)))
    )


def _in_order() -> Column:
    return F.sort_array(F.collect_list(F.struct(_RANGE, _RUNS)))


def transition_funnel(
    events: DataFrame,
    keys: list[str],
    steps: list[str],
    *,
    time_col: str = "event_time",
    event_col: str = "event_name",
    ranges: Sequence[int] = RANGES,
) -> DataFrame:
    """One row per key that reached ``steps[0]``: ``keys``, then
    ``<step>_time`` for every step. Rows with a null key or time are left out.
    ``ranges``: lengths in seconds, each a multiple of the one before."""
    keys, n = list(keys), len(steps)
    if n < 1:
        raise ValueError("a funnel needs at least one step")
    if len(set(steps)) != n:
        # Each step is an event name and names its output column.
        raise ValueError(f"funnel steps must be distinct event names: {steps}")
    if not ranges or any(b % a for a, b in zip(ranges, ranges[1:])) or min(ranges) < 1:
        raise ValueError(f"ranges must be multiples of each other, finest first: {ranges}")
    time_type = events.schema[time_col].dataType.simpleString()
    at = F.col(time_col)
    step = F.array_position(F.array(*map(F.lit, steps)), F.col(event_col)) - 1
    rows = events.where(F.col(event_col).isin(steps) & _not_null([*keys, time_col])).select(
        *keys,
        F.floor(F.unix_micros(at.cast("timestamp")) / F.lit(ranges[0] * 1_000_000)).alias(_RANGE),
        step.alias(_STEP),
        F.when(F.col(event_col) != steps[0], at).alias(_LATER),
        at.alias(_TIME),
    )
    met = rows.groupBy(*keys, _RANGE, _STEP, _LATER).agg(F.min(_TIME).alias(_TIME))
    done_in = met.groupBy(*keys, _RANGE).agg(F.collect_list(F.struct(F.col(_STEP).alias("nr"), F.col(_TIME).alias("time"))).alias(_DONE))
    runs = F.when(F.size(_DONE) == 1, _single(F.get(_DONE, F.lit(0)), n, time_type)).otherwise(_table(_by_step(F.col(_DONE), n), n, time_type))
    tables = done_in.select(*keys, _RANGE, runs.alias(_RUNS))
    for finer, coarser in zip(ranges, ranges[1:]):
        wide = F.floor(F.col(_RANGE) / (coarser // finer)).alias("_wide")
        tables = tables.groupBy(*keys, wide).agg(_in_order().alias("_tables"))
        tables = tables.select(*keys, F.col("_wide").alias(_RANGE), _composed(F.col("_tables"), n, time_type).alias(_RUNS))
    started = F.bool_or(F.size(F.get(_RUNS, F.lit(0))) > 0).alias("_started")
    done = tables.groupBy(*keys).agg(_in_order().alias("_tables"), started).where("_started")
    return done.select(*keys, _passed(F.col("_tables"), F.lit(0), time_type).alias("_done")).select(
        *keys, *[F.get("_done", F.lit(i)).alias(step_time_column(s)) for i, s in enumerate(steps)]
    )
