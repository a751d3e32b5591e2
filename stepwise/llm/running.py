"""Running totals over a whole table in a global order (DataFrame only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stepwise.llm.scratch import materialize


def running_totals(df: DataFrame, order: list[str], totals: dict[str, str]) -> DataFrame:
    """Adds, for each ``name: column`` of ``totals``, the sum of ``column``
    over all rows up to and with this one in ascending ``order`` (columns that
    order the rows totally, or whose ties may fall either way).

    The rows are range-partitioned and written; one sum per partition gives
    each partition's base by a prefix sum (a table of as many rows as there are
    partitions), and a window inside each partition does the rest. No task
    sees more than its range.
    """
    part = "_range"
    rows = materialize(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "ranges")
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(part).agg(*[F.sum(c).alias(f"_sum_{n}") for n, c in totals.items()])
    bases = materialize(
        sums.select(part, *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_base_{n}") for n in totals]),
        "bases",
    )
    inside = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(bases, part).select(
        *df.columns, *[(F.col(f"_base_{n}") + F.sum(c).over(inside)).alias(n) for n, c in totals.items()]
    )
