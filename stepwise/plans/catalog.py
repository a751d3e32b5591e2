"""Query catalog: every mart and operator as a lazily composed DataFrame.

``Marts`` wraps one raw-events DataFrame and exposes each layer as a
property; properties are memoised DataFrame objects (plans, not data), so a
mart that needs several layers shares the same logical sub-plans and Spark
can reuse their exchanges. Building a layer starts no job. Marts that need
several funnels call ``shared()`` first, which writes the few columns they
need once, in one pass over the raw events per source.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepwise.functions.columns import param_int, session_key
from stepwise.operators.staging import stg_events, stg_items
from stepwise.plans import funnels, incremental, performance, profile, quality, revenue, summary, views
from stepwise.plans.narrow import ITEM_COLUMNS, STEP_COLUMNS, write_once
from stepwise.session import shared_dir
from stepwise.sources.export import MART_NAMES, as_cells, export_all, read_csv, read_exports, write_csv
from stepwise.sources.fixture import load_raw
from stepwise.sources.ga4 import apply_window, events_in_windows, read_raw_events, replace_days, write_raw_events


class Marts:
    def __init__(
        self,
        raw: DataFrame,
        window: tuple[str, str] | None = None,
        staged: tuple[DataFrame, DataFrame] | None = None,
    ):
        """``raw``: events in the raw nested schema. ``staged``: optional
        already materialised (stg_events, stg_items) to build on instead of
        re-deriving them from ``raw``."""
        self.raw_all = raw
        self.window = window
        self._staged = staged
        self._given: dict[str, DataFrame] = {}

    def with_tables(self, **tables: DataFrame) -> "Marts":
        """A copy whose named layers are the given (e.g. materialised)
        DataFrames; everything downstream of them builds on those."""
        m = Marts(self.raw_all, self.window, self._staged)
        m._given = {**self._given, **tables}
        m.__dict__.update(m._given)  # pre-fills the cached properties
        return m

    def shared(self, *, events: bool = True, items: bool = False) -> "Marts":
        """A copy whose event (and item) layer is a written table of the
        columns that funnels, segments, revenue and checks read: one raw pass
        per source, however many funnels are built on it. The tables lie in
        the shared checkpoint folder, which also cuts the lineage."""
        tables = {}
        if events:
            tables["stg_events"] = write_once(self.stg_events.select(*STEP_COLUMNS), "events")
        if items:
            tables["stg_items"] = write_once(
                performance.category_events(self.stg_items).select(*ITEM_COLUMNS), "items"
            )
        return self.with_tables(**tables)

    def counted(self) -> "Marts":
        """A copy whose funnel step counts (one row per step) are written, for
        marts that start from them several times."""
        return self.with_tables(funnel_counts=write_once(self.funnel_counts, "counts"))

    def written(self, *names: str) -> "Marts":
        """A copy whose named layers are written, for several marts that build on
        them. Layers that build on others come after them."""
        m = self
        for name in names:
            m = m.with_tables(**{name: write_once(getattr(m, name), name)})
        return m

    def for_all_marts(self) -> "Marts":
        """A copy for writing all marts: each funnel, the revenue of transactions
        and the category mart are computed once, though the channel mart and
        the step counts, the leakage and the checks read them again."""
        shared = self.shared(events=True, items=True).written("session_funnel_steps").counted()
        return shared.written("revenue_baseline", "category_performance")

    # ---------------------------------------------------------- staging --
    @cached_property
    def raw(self) -> DataFrame:
        return apply_window(self.raw_all, self.window)

    @cached_property
    def stg_events(self) -> DataFrame:
        return self._staged[0] if self._staged else stg_events(self.raw_all, self.window)

    @cached_property
    def stg_items(self) -> DataFrame:
        return self._staged[1] if self._staged else stg_items(self.raw_all, self.window)

    # ---------------------------------------------------------- funnels --
    @cached_property
    def user_funnel_steps(self) -> DataFrame:
        return funnels.user_funnel_steps(self.stg_events)

    @cached_property
    def session_funnel_steps(self) -> DataFrame:
        return funnels.session_funnel_steps(self.stg_events)

    @cached_property
    def checkout_funnel_steps(self) -> DataFrame:
        return funnels.checkout_funnel_steps(self.stg_events)

    @cached_property
    def category_session_funnel(self) -> DataFrame:
        return funnels.category_session_funnel(performance.category_events(self.stg_items))

    @cached_property
    def user_funnel_status(self) -> DataFrame:
        return funnels.user_funnel_status(self.user_funnel_steps)

    # ---------------------------------------------------------- summary --
    @cached_property
    def funnel_counts(self) -> DataFrame:
        return summary.funnel_counts(
            self.user_funnel_steps, self.session_funnel_steps, self.checkout_funnel_steps
        )

    @cached_property
    def funnel_summary(self) -> DataFrame:
        return summary.funnel_summary(self.funnel_counts)

    @cached_property
    def funnel_transitions(self) -> DataFrame:
        return summary.funnel_transitions(self.funnel_summary)

    # ---------------------------------------------------------- revenue --
    @cached_property
    def transaction_revenue(self) -> DataFrame:
        return revenue.transaction_revenue(self.stg_events)

    @cached_property
    def revenue_baseline(self) -> DataFrame:
        return revenue.revenue_baseline(self.transaction_revenue)

    @cached_property
    def revenue_leakage(self) -> DataFrame:
        return revenue.revenue_leakage(self.funnel_transitions, self.revenue_baseline)

    @cached_property
    def friction_score(self) -> DataFrame:
        return revenue.friction_score(self.revenue_leakage)

    # ------------------------------------------------------ performance --
    @cached_property
    def category_revenue(self) -> DataFrame:
        return performance.category_revenue(self.stg_items)

    @cached_property
    def category_performance(self) -> DataFrame:
        return performance.category_performance(
            performance.category_summary(self.category_session_funnel), self.category_revenue
        )

    @cached_property
    def session_segments(self) -> DataFrame:
        return performance.session_segments(self.stg_events)

    @cached_property
    def session_funnel_segmented(self) -> DataFrame:
        """Session funnel carrying each session's (channel, device)."""
        return performance.session_funnel_segmented(self.session_funnel_steps, self.session_segments)

    @cached_property
    def channel_device_performance(self) -> DataFrame:
        return performance.channel_device_performance(self.session_funnel_segmented)

    # ---------------------------------------------------------- quality --
    @cached_property
    def data_quality_checks(self) -> DataFrame:
        return quality.data_quality_checks(
            self.category_performance,
            self.friction_score,
            self.funnel_summary,
            self.revenue_leakage,
            self.stg_events,
        )

    # ---------------------------------------------------------- profile --
    @cached_property
    def windowed_events(self) -> DataFrame:
        return profile.windowed_events(self.stg_events)

    @cached_property
    def event_name_counts(self) -> DataFrame:
        return profile.event_name_counts(self.raw)

    @cached_property
    def dataset_profile(self) -> DataFrame:
        return profile.dataset_profile(self.raw)

    @cached_property
    def null_session_audit(self) -> DataFrame:
        return profile.null_session_audit(self.stg_events)

    @cached_property
    def purchase_audit(self) -> DataFrame:
        return profile.purchase_audit(self.stg_events)

    @cached_property
    def traffic_device_coverage(self) -> DataFrame:
        return profile.traffic_device_coverage(self.stg_events)

    @cached_property
    def traffic_channels(self) -> DataFrame:
        return profile.traffic_channels(self.stg_events)

    @cached_property
    def category_coverage(self) -> DataFrame:
        return profile.category_coverage(self.stg_items)

    @cached_property
    def category_cleaning(self) -> DataFrame:
        return profile.category_cleaning(self.stg_items)

    @cached_property
    def event_field_sample(self) -> DataFrame:
        return profile.event_field_sample(self.raw)

    @cached_property
    def item_field_sample(self) -> DataFrame:
        return profile.item_field_sample(self.raw)

    @cached_property
    def event_param_lookup(self) -> DataFrame:
        return profile.event_param_lookup(self.stg_events)


# Layer -> view name of the original model files (CREATE OR REPLACE VIEW).
VIEW_NAMES = {
    "stg_events": "stg_events",
    "stg_items": "stg_items",
    "user_funnel_steps": "int_user_funnel_steps",
    "session_funnel_steps": "int_session_funnel_steps",
    "checkout_funnel_steps": "int_checkout_funnel_steps",
    "funnel_summary": "mart_funnel_summary",
    "channel_device_performance": "mart_channel_device_performance",
    "category_performance": "mart_category_performance",
    "revenue_leakage": "mart_revenue_leakage",
    "friction_score": "mart_friction_score",
    "data_quality_checks": "data_quality_checks",
}


def register_views(marts: Marts, names: list[str] | None = None) -> list[str]:
    """Register layers as session temp views under the model names, so
    ``spark.sql("SELECT * FROM mart_friction_score")`` works as before."""
    done = []
    for attr in names or list(VIEW_NAMES):
        getattr(marts, attr).createOrReplaceTempView(VIEW_NAMES[attr])
        done.append(VIEW_NAMES[attr])
    return done


# Every registered query, in build order.
QUERY_NAMES = [
    "event_name_counts",
    "dataset_profile",
    "null_session_audit",
    "purchase_audit",
    "traffic_device_coverage",
    "category_coverage",
    "event_field_sample",
    "item_field_sample",
    "event_param_lookup",
    "stg_events",
    "stg_items",
    "traffic_channels",
    "category_cleaning",
    "user_funnel_steps",
    "user_funnel_status",
    "session_funnel_steps",
    "checkout_funnel_steps",
    "category_session_funnel",
    "session_segments",
    "transaction_revenue",
    "revenue_baseline",
    "category_revenue",
    "funnel_summary",
    "funnel_transitions",
    "channel_device_performance",
    "category_performance",
    "revenue_leakage",
    "friction_score",
    "data_quality_checks",
    "windowed_events",
]


#: Analysis window of the two windowed queries (the others read every row).
WINDOW = ("20240108", "20240114")
#: Bounds of the two ``scaled_*`` queries, such that every label occurs in
#: the table at sf0.01, too.
SCALED_TIERS = [(9_500, "Very High"), (5_000, "High"), (1_300, "Medium")]
SCALED_VOLUME = 104


def fixture_marts(spark: SparkSession, sf_dir: str, window: tuple[str, str] | None = None) -> Marts:
    """Marts over the driver's ``events`` table: every row, or a window."""
    return Marts(load_raw(spark, sf_dir), window)


def _sharded_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windowed report through the sharded source: the raw records
    written by date in the shared folder, read back by window."""
    path = shared_dir(spark, "sharded")
    write_raw_events(load_raw(spark, sf_dir), path)
    return Marts(read_raw_events(spark, path, WINDOW)).windowed_events


def _export_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All marts written as CSV; the category mart as read back."""
    marts = fixture_marts(spark, sf_dir).for_all_marts()
    out = shared_dir(spark, "exports")
    for name in MART_NAMES:
        write_csv(name, getattr(marts, name), out)
    return read_csv("category_performance", marts.category_performance.schema, out, spark)


def _export_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All marts written as CSV with a manifest, read back by it and compared
    with it; every value of every file."""
    marts = fixture_marts(spark, sf_dir).for_all_marts()
    out = export_all({name: getattr(marts, name) for name in MART_NAMES}, shared_dir(spark, "exports"))
    cells = [as_cells(name, df) for name, df in read_exports(spark, out).items()]
    return reduce(DataFrame.unionByName, cells)


def _view_chain(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """A mart read through catalog views. The views are first made over a
    week; then the two staging views are replaced by ones over all days, and the
    mart, which was not touched, is read."""
    path = shared_dir(spark, "views")
    database = path.rsplit("/", 1)[-1].replace("-", "_")
    views.create_database(spark, database, path)
    views.save_raw(load_raw(spark, sf_dir), database)
    views.create_views(spark, database, WINDOW)
    views.create_views(spark, database, only=["stg_events", "stg_items"])
    return spark.table(f"{database}.{view}")


def _reloaded_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users, sessions and revenue per day of a sharded table whose days of
    ``WINDOW`` were first loaded without purchases and then loaded again."""
    raw = load_raw(spark, sf_dir)
    path = shared_dir(spark, "reloaded")
    inside = F.col("event_date").between(*WINDOW)
    write_raw_events(raw.where(~inside | (F.col("event_name") != "purchase") | F.col("event_name").isNull()), path)
    replace_days(raw.where(inside), path)
    return profile.daily_totals(Marts(read_raw_events(spark, path, None)).stg_events)


def _colocated(name: str, tables: list[str]) -> Callable[[SparkSession, str], DataFrame]:
    """A layer built on tables that are bucketed by its key."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from stepwise.plans.colocated import in_shared_folder

        return getattr(in_shared_folder(fixture_marts(spark, sf_dir), tables), name)

    return run


def _observed_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality checks, observed while staging and marts are written."""
    from stepwise.plans.pipeline import run_checked

    return run_checked(load_raw(spark, sf_dir), None, shared_dir(spark, "exports"))


def _merged_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The revenue baseline of a state that was loaded in three parts which
    overlap, one of them twice and late."""
    events = fixture_marts(spark, sf_dir).stg_events
    state = incremental.TransactionState(spark, shared_dir(spark, "transactions")).create()
    day = F.col("event_date")
    lo, hi = (F.to_date(F.lit(d), "yyyyMMdd") for d in WINDOW)
    for load, rows in {
        "after": events.where(day > lo),
        "before": events.where((day <= hi) | day.isNull()),
        "again": events.where(day.between(lo, hi)),
    }.items():
        state.merge(rows, load)
    return revenue.revenue_baseline(state.transactions())


def _merged_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users and sessions per week: exact, and whether the count of the
    merged daily sketches is within five standard errors of it."""
    events = fixture_marts(spark, sf_dir).stg_events
    path = shared_dir(spark, "sketches")
    incremental.write_sketches(incremental.daily_sketches(events), path)
    week = F.date_trunc("week", "event_date").cast("date").alias("week")
    daily = incremental.read_sketches(spark, path).withColumn("week", week)
    merged = incremental.merged_counts(daily, "week")
    names = list(incremental.COUNTED)
    exact = events.groupBy(week).agg(*[F.countDistinct(c).alias(n) for n, c in incremental.COUNTED.items()])
    bound = 5 * incremental.STANDARD_ERROR
    near = [(F.abs(F.col(f"estimated_{n}") - F.col(n)) <= bound * F.col(n) + 1).alias(f"{n}_near") for n in names]
    return merged.join(exact, "week").select("week", "days", "event_count", *names, *near)


def _windows_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and sessions of windows that are only known from the data: the
    first and the last week of the table."""
    path = shared_dir(spark, "sharded")
    write_raw_events(load_raw(spark, sf_dir), path)
    raw = read_raw_events(spark, path, None)
    day = F.to_date("event_date", "yyyyMMdd")
    ends = raw.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    windows = ends.select(
        F.inline(
            F.array(
                F.struct(F.lit("first week").alias("window"), F.col("first").alias("lo"), F.date_add("first", 6).alias("hi")),
                F.struct(F.lit("last week").alias("window"), F.date_sub("last", 6).alias("lo"), F.col("last").alias("hi")),
            )
        )
    ).select("window", *[F.date_format(c, "yyyyMMdd").alias(c) for c in ("lo", "hi")])
    seen = events_in_windows(raw, windows)
    key = session_key("user_pseudo_id", param_int("event_params", "ga_session_id"))
    return seen.groupBy("window", "event_name").agg(F.count(F.lit(1)).alias("event_count"), F.countDistinct(key).alias("sessions"))


def _scaled_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fixture_marts(spark, sf_dir).shared()
    return revenue.revenue_leakage(m.funnel_transitions, m.revenue_baseline, SCALED_TIERS)


def _scaled_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fixture_marts(spark, sf_dir).shared(events=False, items=True)
    return performance.category_performance(
        performance.category_summary(m.category_session_funnel), m.category_revenue, SCALED_VOLUME
    )


#: Queries that build several funnels, or read a source several times: which
#: sources they write narrow first, and whether they start from the step
#: counts more than once.
SHARED: dict[str, dict] = {
    "funnel_summary": {"events": True},
    "funnel_transitions": {"events": True},
    "channel_device_performance": {"events": True},
    "revenue_leakage": {"events": True},
    "friction_score": {"events": True},
    "category_performance": {"events": False, "items": True},
    "data_quality_checks": {"events": True, "items": True},
}
COUNTED = {"data_quality_checks"}


def query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        marts = fixture_marts(spark, sf_dir, WINDOW if name == "windowed_events" else None)
        if name in SHARED:
            marts = marts.shared(**SHARED[name])
        if name in COUNTED:
            marts = marts.counted()
        return getattr(marts, name)

    run.__name__ = name
    return run


OTHER_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "sharded_window": _sharded_window,
    "export_marts": _export_marts,
    "export_cells": _export_cells,
    "view_friction_score": lambda spark, sf_dir: _view_chain(spark, sf_dir, "mart_friction_score"),
    "view_data_quality_checks": lambda spark, sf_dir: _view_chain(spark, sf_dir, "data_quality_checks"),
    "reloaded_days": _reloaded_days,
    "colocated_channel_device": _colocated("channel_device_performance", ["session_events"]),
    "colocated_category": _colocated("category_performance", ["session_items"]),
    "observed_quality_checks": _observed_checks,
    "merged_baseline": _merged_baseline,
    "merged_distinct": _merged_distinct,
    "windows_report": _windows_report,
    "scaled_revenue_leakage": _scaled_leakage,
    "scaled_category_performance": _scaled_categories,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: query(n) for n in QUERY_NAMES} | OTHER_QUERIES
