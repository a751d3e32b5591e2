"""Joins whose hot keys adaptive execution can split.

A single key (a bot user, a runaway session) may hold a third of all rows of
the large side. Adaptive skew-join splitting handles that, but only where an
exchange stands directly under the join: a side that was just aggregated by
the join keys is already partitioned by them, so Spark joins it in place and
has nothing to split. ``split_join`` adds a join key that is 0 for every row
but that the optimizer cannot fold. Neither side is partitioned by it, so both
get an exchange of their own, and Spark splits the large partitions of the
left side at run time by their measured size: no thresholds of our own, no
statistics pass, no salt.

It relies on two settings at their defaults:
``spark.sql.adaptive.skewJoin.enabled`` and
``spark.sql.requireAllClusterKeysForCoPartition`` (both true).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AGAIN = "_again"


def split_join(big: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """``big INNER JOIN small USING (keys)``, ``small`` with one row per key.

    The join stays an inner one: of a left join only the left side could be
    split. Whatever groups the result by the keys gets an exchange, too, so a
    result that is used twice is computed once (Spark reuses exchanges)."""
    again = F.pmod(F.xxhash64(*keys), F.lit(1))
    return big.withColumn(AGAIN, again).join(small.withColumn(AGAIN, again), [*keys, AGAIN]).drop(AGAIN)
