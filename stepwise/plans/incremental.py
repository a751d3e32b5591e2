"""State that is carried from load to load: transactions and distinct counts.

**Transactions.** ``TransactionState`` holds one row per transaction id, the
greatest revenue seen. A load is reduced to the same form and merged by the
maximum, which is idempotent and does not depend on order: a replayed load, a
late event or an overlapping window leaves the state that one full run over all
events gives. Each merge writes the next version whole and readers take the last
version that was written to its end, so a load that fails half-way changes
nothing and can be run again.

**Distinct counts.** ``daily_sketches`` keeps, per day, the exact counts and a
mergeable sketch (HyperLogLog, ``2^LG_K`` registers) of users and of sessions.
Days are replaced like the days of the raw table. ``merged_counts`` unites the
sketches of any set of days without reading an event.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepwise.plans.revenue import transaction_revenue

STATE_SCHEMA = T.StructType([T.StructField("transaction_id", T.StringType()), T.StructField("transaction_revenue", T.DoubleType())])
LOADS = "version long, load string"
#: Registers of a sketch, as a power of 2, and the relative standard error that it has.
LG_K = 12
STANDARD_ERROR = 1.04 / math.sqrt(1 << LG_K)


class TransactionState:
    """Transactions by id below ``path``: ``version=N`` folders and a log of
    the loads that made them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _log(self) -> str:
        return f"{self.path}/log"

    def _data(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def create(self) -> "TransactionState":
        """An empty state (one that is there is kept)."""
        self.spark.createDataFrame([], LOADS).write.mode("ignore").parquet(self._log())
        return self

    def loads(self) -> DataFrame:
        """``version, load`` of the merges so far, a row each."""
        return self.spark.read.schema(LOADS).parquet(self._log())

    def version(self) -> int:
        """The last version that was written to its end; 0: none yet."""
        return self.loads().agg(F.max("version")).first()[0] or 0

    def transactions(self) -> DataFrame:
        """``transaction_id, transaction_revenue``, one row per id."""
        at = self.version()
        return self.spark.read.schema(STATE_SCHEMA).parquet(self._data(at)) if at else self.spark.createDataFrame([], STATE_SCHEMA)

    def merge(self, stg_events: DataFrame, load: str) -> int:
        """Merge the purchases of a load and return the version. The version is
        written first and then named in the log: what a failed merge leaves
        behind is overwritten by the next one."""
        new = transaction_revenue(stg_events).select(*STATE_SCHEMA.names)
        at = self.version() + 1
        (
            self.transactions()
            .unionByName(new)
            .groupBy("transaction_id")
            .agg(F.max("transaction_revenue").alias("transaction_revenue"))
            .write.mode("overwrite")
            .parquet(self._data(at))
        )
        self.spark.createDataFrame([(at, load)], LOADS).coalesce(1).write.mode("append").parquet(self._log())
        return at


COUNTED = {"users": "user_pseudo_id", "sessions": "session_key"}


def daily_sketches(stg_events: DataFrame) -> DataFrame:
    """Per day: events, exact distinct users and sessions, and their sketches."""
    return stg_events.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("event_count"),
        *[F.countDistinct(c).alias(n) for n, c in COUNTED.items()],
        *[F.hll_sketch_agg(c, F.lit(LG_K)).alias(f"{n}_sketch") for n, c in COUNTED.items()],
    )


def write_sketches(daily: DataFrame, path: str) -> None:
    """Write the days that ``daily`` holds over the same days of the table."""
    daily.repartition("event_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([
        T.StructField("event_count", T.LongType()),
        *[T.StructField(n, T.LongType()) for n in COUNTED],
        *[T.StructField(f"{n}_sketch", T.BinaryType()) for n in COUNTED],
        T.StructField("event_date", T.DateType()),
    ])
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def merged_counts(daily: DataFrame, *keys: str) -> DataFrame:
    """Per value of ``keys`` (columns of ``daily``): days, events and the
    estimated distinct users and sessions of its days together."""
    return daily.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("days"),
        F.sum("event_count").alias("event_count"),
        *[F.hll_sketch_estimate(F.hll_union_agg(f"{n}_sketch")).alias(f"estimated_{n}") for n in COUNTED],
    )
