"""Connected components of a graph given as an edge table (DataFrame only).

Distributed union-find by alternating star operations: every node links its
larger neighbours to its smallest one (large star), then every node links its
smaller neighbours to the smallest of them (small star), until the edges no
longer change and each component is a star around its smallest node. Rounds
grow with the logarithm of the component size, not with its diameter. Each
round is one written table, so a lost executor costs at most a round and the
plan stays small; the only numbers that come to the driver are a count and a
checksum per round.

A node with very many neighbours is an ordinary case (the centre of a large
star): its minimum is pre-aggregated before the shuffle, and the join that
brings the minimum back to its edges is one that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepwise.llm.scratch import materialize


def split_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``big`` joined to ``small`` (one row per key) so that adaptive execution
    can split the hot keys of ``big``.

    A side that was just aggregated by the join keys is joined in place, and
    Spark then has no exchange to split. The extra key below is a constant that
    the optimizer can't fold: it asks for a new exchange under both sides.
    (With ``spark.sql.requireAllClusterKeysForCoPartition`` and
    ``spark.sql.adaptive.skewJoin.enabled`` at their defaults.)
    """
    again = "_again"
    part = F.pmod(F.xxhash64(*keys), F.lit(1))
    return big.withColumn(again, part).join(small.withColumn(again, part), [*keys, again], how).drop(again)


def _state(edges: DataFrame) -> tuple:
    # The sum of hashes is order-free; decimals don't overflow.
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("u").alias("a"), F.col("v").alias("b")).union(edges.select("v", "u"))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    large = (
        split_join(both, least, ["a"])
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("u"), F.least("a", "m").alias("v"))
        .distinct()
    )
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    return (
        split_join(large, least, ["u"])
        .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links(u long, v long)``; a
    component is named after its smallest node. Loops, repeated links and
    either direction are fine; links with a null end are ignored; no links
    give no rows."""
    edges = materialize(
        links.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "links",
    )
    state = _state(edges)
    while state[0]:
        edges = materialize(_star(edges), "star")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct()
    )
