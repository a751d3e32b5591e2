"""Sharded raw-event source.

The raw export is one shard per day. On Spark that is a parquet table
partitioned by the ``event_date`` string directory; an inclusive string range
on it becomes a PartitionFilter. With a window, only the folders whose names
lie in its string range are handed to the reader (their names are listed, one
level and no files), so the files of the other days are never listed. String
comparison matters: ``20201115_fresh`` lies inside a window of such days, while
``intraday_...`` sorts outside it, as they do in the source warehouse.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stepwise.sources.schema import EVENT_SCHEMA

# The analysis window of the original study.
DEFAULT_WINDOW = ("20201101", "20210131")
#: Tasks that write one day in ``replace_days``.
SHARD_FILES = 16


def window_predicate(window: tuple[str, str] | None) -> Column | None:
    if window is None:
        return None
    lo, hi = window
    return F.col("event_date").between(F.lit(lo), F.lit(hi))


def apply_window(raw: DataFrame, window: tuple[str, str] | None) -> DataFrame:
    """Inclusive ``event_date BETWEEN lo AND hi`` on the raw string column
    (kept on the raw column, not the parsed date, so it prunes partitions)."""
    pred = window_predicate(window)
    return raw if pred is None else raw.where(pred)


def read_raw_events(
    spark: SparkSession, path: str, window: tuple[str, str] | None = DEFAULT_WINDOW
) -> DataFrame:
    """Read a parquet events table laid out as ``path/event_date=YYYYMMDD/``.

    The schema is declared (no inference pass over 100 TB of footers) and the
    partition column stays a string. A window without any day in the table
    gives no rows; without a window the whole table is read.
    """
    reader = spark.read.schema(EVENT_SCHEMA).option("basePath", path)
    if window is None:
        return reader.parquet(path)
    there = _shards(spark, path, window)
    if not there:
        return spark.createDataFrame([], EVENT_SCHEMA)
    return apply_window(reader.parquet(*there), window)


def events_in_windows(raw: DataFrame, windows: DataFrame) -> DataFrame:
    """The events of each of ``windows(window, lo, hi)`` with its name (an event
    of two windows is there twice). ``lo`` and ``hi`` are inclusive days
    (yyyyMMdd); a window whose ``lo`` is after its ``hi`` has no events.

    The windows are known at run time only. Their days are joined to the
    partition column, so Spark prunes the folders by the days it finds (dynamic
    partition pruning) and reads no others. A table of days is small: a row per
    window and day, far below any broadcast threshold; it is not hinted, so a
    long list of windows is left to Spark's measure."""
    first, last = (F.to_date(c, "yyyyMMdd") for c in ("lo", "hi"))
    days = windows.where(F.col("lo") <= F.col("hi")).select(
        "window", F.explode(F.transform(F.sequence(first, last), lambda d: F.date_format(d, "yyyyMMdd"))).alias("event_date")
    )
    return raw.join(days, "event_date")


def _shards(spark: SparkSession, path: str, window: tuple[str, str]) -> list[str]:
    """The ``event_date=`` folders of ``path`` inside the window; one listing of its first level."""
    lo, hi = window
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    names = (s.getPath().getName() for s in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root) if s.isDirectory())
    prefix = "event_date="
    # Names are escaped as Spark writes them.
    inside = (n for n in names if n.startswith(prefix) and lo <= unquote(n[len(prefix) :]) <= hi)
    return [f"{path.rstrip('/')}/{n}" for n in sorted(inside)]


def replace_days(raw: DataFrame, path: str, days: list[str] | None = None) -> None:
    """Write the days that ``raw`` holds (``days``: those of them only) over the
    same days of the table at ``path`` and leave every other folder as it is.

    Shards are replaced whole, so loading a day twice, or again after late
    events have come, gives what one full load of the newest records gives. Each
    task writes to a staging folder, and folders are exchanged when all tasks have
    ended: a lost executor costs its tasks, never half a day. A day that
    ``raw`` has no record of is not touched."""
    if days is not None:
        raw = raw.where(F.col("event_date").isin(days))
    # One shuffle by day and a hash of the record, so that a day is written by
    # several tasks, each with one file per day it holds.
    spread = F.pmod(F.xxhash64("event_timestamp", "user_pseudo_id"), F.lit(SHARD_FILES))
    (
        raw.repartition("event_date", spread)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date")
        .parquet(path)
    )


def write_raw_events(raw: DataFrame, path: str) -> None:
    """Write raw events as a date-partitioned table (the layout
    ``read_raw_events`` prunes on)."""
    raw.write.mode("overwrite").partitionBy("event_date").parquet(path)
