"""Intermediate tables of the operators in this subpackage.

They are written as Parquet below the shared folder that the session names in
``spark.checkpoint.dir``: a written table cuts the lineage, survives lost
executors and has a known size, so the planner broadcasts it only when that
size is below its threshold.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from stepwise.session import checkpoint_dir

#: Whole texts that travel to a Python worker together.
TEXT_ROWS = 1024
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A new folder (not yet made) in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/stepwise-llm/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once and return it as read back."""
    path = scratch_dir(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def text_batches(spark: SparkSession) -> Iterator[None]:
    """What is written inside hands rows to Python ``TEXT_ROWS`` at a time at
    most: a batch lies in the JVM's and in the worker's memory, several times
    over, and Spark bounds its rows only (10,000 texts are tens of MB)."""
    before = spark.conf.get(_BATCH)
    if 0 < int(before) <= TEXT_ROWS:
        yield
        return
    spark.conf.set(_BATCH, str(TEXT_ROWS))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """What is planned and run inside has these settings of the session."""
    before = {name: spark.conf.get(name, None) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
