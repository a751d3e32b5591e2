"""Production run: stage once, materialise the funnels once, build every mart.

In the original study every mart re-expands the view chain down to the
raw nested records. At scale that means one full scan of the raw table per
funnel step. Here the staging layer is written once as a table partitioned
by ``event_date`` in the shared folder the cluster names in
``spark.checkpoint.dir`` (this also cuts lineage: a lost executor re-reads
the staged files instead of recomputing from raw). Marts then read only the
narrow columns they need, with partition and column pruning, and each
date partition is sorted by ``event_name`` so parquet row-group statistics
let per-step filters skip row groups of other events. The per-key funnel
tables (the intermediate layer) are materialised the same way, because four
of the six marts share the same three funnels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stepwise.operators.staging import STG_EVENTS_COLUMNS, STG_ITEMS_COLUMNS
from stepwise.plans.catalog import VIEW_NAMES, Marts
from stepwise.plans.quality import Observed
from stepwise.session import shared_dir
from stepwise.sources.export import MART_NAMES, write_csv


def _write_staged(df: DataFrame, path: str) -> None:
    # Sorting neither drops nor repeats rows, so what is observed of df is what is written.
    (
        df.sortWithinPartitions("event_date", "event_name")
        .write.mode("overwrite")
        .partitionBy("event_date")
        .parquet(path)
    )


def _read_staged(spark: SparkSession, path: str, schema: T.StructType, columns: list[str]) -> DataFrame:
    # Declared schema: the date partition column keeps its type, and no
    # footer/partition inference pass runs over the table.
    return spark.read.schema(schema).option("basePath", path).parquet(path).select(*columns)


def stage(marts: Marts, out_dir: str | None = None, checks: Observed | None = None) -> Marts:
    """Materialise stg_events and stg_items under ``out_dir`` (default: a
    fresh folder under the session's checkpoint dir) and return a ``Marts``
    that builds on them. ``checks``: those of the staging layer are observed
    while it is written."""
    spark = marts.stg_events.sparkSession
    base = (out_dir or shared_dir(spark, "layers")).rstrip("/")
    ev, it = marts.stg_events, marts.stg_items
    _write_staged(checks.watch("stg_events", ev) if checks else ev, f"{base}/stg_events")
    _write_staged(it, f"{base}/stg_items")
    staged = (
        _read_staged(spark, f"{base}/stg_events", ev.schema, STG_EVENTS_COLUMNS),
        _read_staged(spark, f"{base}/stg_items", it.schema, STG_ITEMS_COLUMNS),
    )
    return Marts(marts.raw_all, marts.window, staged=staged)


# Intermediate (per-key) layers written by ``stage_intermediate``.
INTERMEDIATE = [
    "user_funnel_steps",
    "session_funnel_segmented",
    "checkout_funnel_steps",
    "category_session_funnel",
]


def stage_intermediate(marts: Marts, out_dir: str | None = None) -> Marts:
    """Materialise the per-key funnel tables once, so the marts that share
    them (summary, leakage, friction, quality each need three funnels)
    read them instead of recomputing the funnel shuffles per mart."""
    spark = marts.stg_events.sparkSession
    base = (out_dir or shared_dir(spark, "layers")).rstrip("/")
    tables = {}
    for name in INTERMEDIATE:
        df = getattr(marts, name)
        path = f"{base}/{name}"
        df.write.mode("overwrite").parquet(path)
        tables[name] = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    # The session funnel is the segmented one without its two labels.
    segmented = tables["session_funnel_segmented"]
    tables["session_funnel_steps"] = segmented.drop("traffic_channel", "device_category")
    return marts.with_tables(**tables)


def run_pipeline(
    raw: DataFrame,
    window: tuple[str, str] | None,
    export_dir: str,
    stage_dir: str | None = None,
) -> dict[str, str]:
    """Stage events and items, materialise the funnel tables, build the six
    reporting marts from them and export them as CSV."""
    staged = stage(Marts(raw, window), stage_dir)
    layered = stage_intermediate(staged, f"{stage_dir.rstrip('/')}/intermediate" if stage_dir else None)
    return {name: write_csv(name, getattr(layered, name), export_dir) for name in MART_NAMES}


def run_checked(
    raw: DataFrame,
    window: tuple[str, str] | None,
    export_dir: str,
    stage_dir: str | None = None,
) -> DataFrame:
    """``run_pipeline`` with the quality checks observed while staging and
    marts are written: nothing that was written is read for a check. Returns the
    checks, which are exported like the other marts."""
    checks = Observed()
    staged = stage(Marts(raw, window), stage_dir, checks)
    layered = stage_intermediate(staged, f"{stage_dir.rstrip('/')}/intermediate" if stage_dir else None)
    for name in MART_NAMES:
        if name != "data_quality_checks":
            write_csv(name, getattr(layered, name), export_dir, checks.watch)
    result = checks.result(raw.sparkSession)
    write_csv("data_quality_checks", result, export_dir)
    return result


def _escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def save_tables(
    marts: Marts,
    database: str,
    names: list[str] | None = None,
    location: str | None = None,
) -> dict[str, str]:
    """Persist layers as catalog tables named like the model views
    (``<database>.mart_friction_score`` ...); the staging tables are
    partitioned by ``event_date``. ``location`` places a new database's
    managed tables (e.g. in the shared folder)."""
    spark = marts.stg_events.sparkSession
    quoted = "`" + database.replace("`", "``") + "`"
    where = " LOCATION {place}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted}" + where.format(place="'" + _escaped(location or "") + "'"))
    layers = stage_intermediate(stage(marts))
    out = {}
    for attr in names or list(VIEW_NAMES):
        table = f"{quoted}.`{VIEW_NAMES[attr]}`"
        writer = getattr(layers, attr).write.mode("overwrite")
        if attr in ("stg_events", "stg_items"):
            writer = writer.partitionBy("event_date")
        writer.saveAsTable(table)
        out[attr] = f"{database}.{VIEW_NAMES[attr]}"
    return out
