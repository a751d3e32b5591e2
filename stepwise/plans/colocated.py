"""Co-located layers: narrow tables bucketed by their key.

The session layers (main funnel, checkout funnel, segments, the segmented funnel)
all group or join by the session, the category funnel by (session, category), the
user funnel by the user. ``bucket`` writes the columns that they read once, as
catalog tables bucketed and sorted by that key: one shuffle, when the table is
written. Whatever groups or joins by the key afterwards starts from the buckets
and needs no exchange; what is left is the exchange of the last aggregate, whose
rows are as few as its groups.

The tables pay where several layers read them, or the same ones again. They keep
a key in one bucket, so a key with a very large share of the rows is better read
from the events (``operators.transitions`` spreads it over ranges of time); rows
without a key, and events that no funnel names, are not written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepwise.plans.catalog import Marts
from stepwise.plans.funnels import CHECKOUT_STEPS, MAIN_STEPS
from stepwise.plans.narrow import ITEM_COLUMNS, STEP_COLUMNS
from stepwise.plans.performance import category_events
from stepwise.plans.views import create_database, quoted
from stepwise.session import shared_dir

SESSION_EVENTS, USER_EVENTS, SESSION_ITEMS = "session_events", "user_events", "session_items"


def _save(df: DataFrame, database: str, table: str, key: str, buckets: int) -> DataFrame:
    name = f"{quoted(database)}.{table}"
    rows = df.where(F.col(key).isNotNull())
    (
        rows.repartition(buckets, key)  # a bucket is one file
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def bucket(marts: Marts, database: str, buckets: int, *, only: list[str] | None = None) -> dict[str, DataFrame]:
    """Write the bucketed tables (``only`` some of them) into ``database``."""
    steps = F.col("event_name").isin([*MAIN_STEPS, *CHECKOUT_STEPS])
    events = marts.stg_events.where(steps).select(*STEP_COLUMNS)
    sources = {
        SESSION_EVENTS: (events, "session_key"),
        USER_EVENTS: (events, "user_pseudo_id"),
        SESSION_ITEMS: (category_events(marts.stg_items).select(*ITEM_COLUMNS), "session_key"),
    }
    wanted = {n: s for n, s in sources.items() if only is None or n in only}
    return {name: _save(df, database, name, key, buckets) for name, (df, key) in wanted.items()}


def colocated(marts: Marts, tables: dict[str, DataFrame]) -> Marts:
    """A copy of ``marts`` whose funnels, segments and what is built on them
    start from the bucketed tables."""
    layers: dict[str, DataFrame] = {}
    if SESSION_EVENTS in tables:
        base = marts.with_tables(stg_events=tables[SESSION_EVENTS])
        names = ("session_funnel_steps", "checkout_funnel_steps", "session_segments", "session_funnel_segmented")
        layers |= {n: getattr(base, n) for n in names}
    if USER_EVENTS in tables:
        layers["user_funnel_steps"] = marts.with_tables(stg_events=tables[USER_EVENTS]).user_funnel_steps
    if SESSION_ITEMS in tables:
        base = marts.with_tables(stg_items=tables[SESSION_ITEMS])
        layers |= {n: getattr(base, n) for n in ("category_session_funnel", "category_revenue")}
    return marts.with_tables(**layers)


def in_shared_folder(marts: Marts, only: list[str] | None = None, buckets: int | None = None) -> Marts:
    """``colocated`` on tables of a new database in the shared folder, with as
    many buckets as there are shuffle partitions."""
    spark = marts.raw_all.sparkSession
    path = shared_dir(spark, "buckets")
    database = path.rsplit("/", 1)[-1].replace("-", "_")
    create_database(spark, database, path)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return colocated(marts, bucket(marts, database, n, only=only))
