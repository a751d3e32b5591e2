"""Exact top-k inner-product search (operator 8).

* Vectors are dealt to cells by their nearest centre and, inside a cell, by
  hash to shards of about ``SHARD_ROWS`` rows, so a cell (or a group of copies)
  of any size is many shards. The centres are the leaves of a ball tree over a
  sample of ``CELL_SAMPLE`` vectors; they decide only what lies together.
* Each shard's ball tree (centre and radius of nested sets of vectors) is
  built once and written, one row per shard.
* A query is sent to shards in the order of the largest inner product that
  their whole ball can hold, ``q.c + |q| r``, in ``ROUNDS``: to the first one,
  to the next few, and then to all that can still reach its k-th score. After
  each round the k-th score over all shards so far is merged and goes along to
  the next ones; a shard whose ball cannot reach it never sees the query.
* In a shard, nodes are taken in the order of the same bound, and the search
  of a query ends when that falls below its current k-th score.

A shard's queries are answered in blocks of about ``BLOCK_QUERIES``, and bounds
are formed for as many queries and ``BLOCK_SHARDS`` shards at a time, so that
no task holds more than that, whatever the size of either side.

Scores are integers: components become ``floor(scale * x)`` in double
precision. Pruning allows for rounding, so it never loses an equal score.

Defined results: vectors that are null, or hold a null or a component that is
not finite (also: not once scaled), and vectors without an id take no part;
vectors of another length than the query have no inner product with it and are
no candidates; rows with the query's id are its own; repeated rows each count
as candidates (they are kept as one row with their number) and are one query;
fewer than ``k`` candidates give all of them; an empty table gives no rows.
Sums beyond 53 bits are formed in exact integers; beyond 64 bits a score is
held at the limit.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stepwise.llm.scratch import materialize

K = 5
SCALE = 256
SHARD_ROWS = 8192
BLOCK_QUERIES = 2048
BLOCK_SHARDS = 1024
LEAF = 256
#: Vectors that the centres of the cells are fitted on, and how many centres.
CELL_SAMPLE, CELLS = 4096, 256
#: Shards that a query is sent to in each round (None: all that are left).
ROUNDS = (1, 8, None)
#: A k-th score that isn't there yet; a null would turn the column into floats.
NO_FLOOR = -(2**63)

FOUND = "query_key long, query_id long, vec_id long, score long"
TREE = "shard int, dim int, radius double, center binary, tree binary"
ROUTE = "query_key long, shard int, reach double"


class BallTree:
    """Nested balls over integer-valued rows; a node is a range of the
    reordered rows, with two nodes inside it or none (-1)."""

    def __init__(self, rows: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(rows))
        centers, radii, spans, kids = [], [], [], []
        todo = [(0, len(rows), -1)]
        while todo:
            lo, hi, parent = todo.pop()
            at = order[lo:hi]
            part = rows[at]
            mid = part.mean(axis=0)
            away = np.sqrt(((part - mid) ** 2).sum(axis=1))
            me = len(spans)
            centers.append(mid)
            radii.append(float(away.max()))
            spans.append((lo, hi))
            kids.append([-1, -1])
            if parent >= 0:
                kids[parent][kids[parent][0] >= 0] = me
            if hi - lo > leaf and radii[me] > 0:
                # Split at the median along the line between two far points.
                a = part[away.argmax()]
                b = part[((part - a) ** 2).sum(axis=1).argmax()]
                half = (hi - lo) // 2
                order[lo:hi] = at[np.argpartition(part @ (b - a), half)]
                todo += [(lo + half, hi, me), (lo, lo + half, me)]
        self.order, self.rows = order, rows[order]
        self.centers, self.radii = np.array(centers), np.array(radii)
        self.spans, self.kids = np.array(spans), np.array(kids)

    def leaves(self) -> np.ndarray:
        """The centres of the nodes without nodes inside."""
        return self.centers[self.kids[:, 0] < 0]


def _bounds(centers: np.ndarray, radii: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """No row of a ball has a larger inner product with a query (one column
    per query)."""
    size = np.sqrt((queries * queries).sum(axis=1))
    reach = centers @ queries.T + radii[:, None] * size
    return reach + 1e-9 * (np.abs(reach) + size * (radii[:, None] + 1)) + 1e-6


def _exact(rows: np.ndarray, q: np.ndarray, most: float) -> np.ndarray:
    """Inner products as 64-bit integers; no component of a row is over ``most``."""
    if len(q) * max(most, 1) * max(np.abs(q).max(initial=0), 1) < 2**53:
        return (rows @ q).astype(np.int64)
    whole = [int(x) for x in q]
    sums = (sum(int(x) * y for x, y in zip(r, whole)) for r in rows)
    return np.array([min(max(s, -(2**63)), 2**63 - 1) for s in sums], dtype=np.int64)


def search(tree: dict, q: np.ndarray, own: int, k: int, floor: int | None) -> list[tuple[int, int]]:
    """The best ``k`` of ``(score, vec_id)`` among rows that reach ``floor``;
    higher scores first, ties to the smaller id. ``tree`` holds the arrays of a
    ball tree and, in its order, the ``ids`` and ``copies`` of the rows."""
    bounds = _bounds(tree["centers"], tree["radii"], q[None, :])[:, 0].tolist()
    kids, spans, most = tree["kids"], tree["spans"], float(tree["most"])
    best: list[tuple[int, int]] = []  # min-heap of (score, -id)
    nodes = [(-bounds[0], 0)]
    while nodes:
        reach, node = heapq.heappop(nodes)
        need = best[0][0] if len(best) == k else floor
        if floor is not None and need is not None:
            need = max(need, floor)
        if need is not None and -reach < need:
            break
        if kids[node, 0] >= 0:
            for kid in kids[node].tolist():
                heapq.heappush(nodes, (-bounds[kid], kid))
            continue
        lo, hi = spans[node]
        scores, near = _exact(tree["rows"][lo:hi], q, most), tree["ids"][lo:hi]
        ok = near != own
        if need is not None:
            ok &= scores >= need
        for score, other, copies in zip(scores[ok].tolist(), (-near[ok]).tolist(), tree["copies"][lo:hi][ok].tolist()):
            for _ in range(min(copies, k)):
                if len(best) < k:
                    heapq.heappush(best, (score, other))
                elif (score, other) > best[0]:
                    heapq.heapreplace(best, (score, other))
    return [(s, -i) for s, i in sorted(best, reverse=True)]


def _scaled(vectors) -> np.ndarray:
    return np.floor(SCALE * np.stack([np.asarray(v, dtype=np.float64) for v in vectors]))


def _cells(centers: dict[int, np.ndarray]):
    """Adds the cell of each vector: its nearest centre of the same length."""

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cell = np.zeros(len(batch), "int32")
            dims = batch["vector"].map(len).to_numpy()
            for dim in np.unique(dims):
                if dim in centers:
                    at, mids = np.flatnonzero(dims == dim), centers[dim]
                    part = _scaled(batch["vector"].iloc[at])
                    cell[at] = ((mids * mids).sum(axis=1) - 2 * part @ mids.T).argmin(axis=1)
            yield batch.assign(cell=cell)

    return deal


def _build(group: pd.DataFrame) -> pd.DataFrame:
    """One row with the ball tree of a shard."""
    group = group.sort_values("vec_id", kind="stable")
    made = BallTree(_scaled(group["vector"]))
    held = io.BytesIO()
    np.savez(
        held,
        rows=made.rows,
        most=np.abs(made.rows).max(initial=0),
        ids=group["vec_id"].to_numpy(np.int64)[made.order],
        copies=group["copies"].to_numpy(np.int64)[made.order],
        **{name: getattr(made, name) for name in ("centers", "radii", "spans", "kids")},
    )
    return pd.DataFrame({
        "shard": group["shard"].iloc[:1].to_numpy(),
        "dim": [made.rows.shape[1]],
        "radius": made.radii[:1],
        "center": [made.centers[0].tobytes()],
        "tree": [held.getvalue()],
    })


def _routes(limit: int | None):
    """The shards of a block that can still reach a query's k-th score: the
    ``limit`` of the largest bounds, or all."""

    def route(queries: pd.DataFrame, shards: pd.DataFrame) -> pd.DataFrame:
        out = []
        for dim, there in shards.groupby("dim"):
            asked = queries[queries["vector"].map(len) == dim]
            if not len(asked):
                continue
            there = there.sort_values("shard")
            numbers = there["shard"].to_numpy()
            mids = np.frombuffer(b"".join(there["center"])).reshape(len(there), dim)
            reach = _bounds(mids, there["radius"].to_numpy(), _scaled(asked["vector"]))
            open_ = np.ones_like(reach, dtype=bool)
            for j, (floor, seen) in enumerate(zip(asked["floor"], asked["seen"])):
                if floor != NO_FLOOR:
                    open_[:, j] = reach[:, j] >= float(floor)
                open_[np.isin(numbers, seen), j] = False
                if limit and open_[:, j].sum() > limit:
                    kept = np.argsort(np.where(open_[:, j], -reach[:, j], np.inf), kind="stable")[:limit]
                    open_[:, j] = False
                    open_[kept, j] = True
            i, j = np.nonzero(open_)
            out.append(pd.DataFrame({"query_key": asked["query_key"].to_numpy()[j], "shard": numbers[i], "reach": reach[i, j]}))
        none = pd.DataFrame({"query_key": np.zeros(0, "i8"), "shard": np.zeros(0, "i4"), "reach": np.zeros(0)})
        return pd.concat([none, *out], ignore_index=True)

    return route


def _answer(k: int):
    def answer(trees: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(trees) and len(queries):
            with np.load(io.BytesIO(trees["tree"].iloc[0])) as held:
                tree = {name: held[name] for name in held.files}
            for row, q in zip(queries.itertuples(), _scaled(queries["vector"])):
                floor = None if row.floor == NO_FLOOR else int(row.floor)
                out += [(row.query_key, row.query_id, i, s) for s, i in search(tree, q, row.query_id, k, floor)]
        return pd.DataFrame(out, columns=["query_key", "query_id", "vec_id", "score"]).astype("int64")

    return answer


def _shards(rows: DataFrame, shard_rows: int) -> DataFrame:
    """The ball trees of ``rows(vec_id, vector, copies)``, one row per shard."""
    spark = rows.sparkSession
    cells = min(CELLS, -(-rows.count() // shard_rows))
    centers: dict[int, np.ndarray] = {}
    if cells > 1:
        drawn = rows.select("vector").orderBy(F.xxhash64("vec_id", "vector")).limit(CELL_SAMPLE).collect()
        by_dim: dict[int, list] = {}
        for r in drawn:
            by_dim.setdefault(len(r.vector), []).append(r.vector)
        centers = {dim: BallTree(_scaled(v), leaf=-(-len(drawn) // cells)).leaves() for dim, v in by_dim.items()}
    placed = rows.mapInPandas(_cells(centers), "vec_id long, vector array<double>, copies long, cell int")
    placed = materialize(placed.withColumn("dim", F.size("vector")), "cells")
    # One row per cell: its shards are numbered behind those of the cells before.
    sizes = placed.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("parts"))
    before = Window.orderBy("dim", "cell").rowsBetween(Window.unboundedPreceding, -1)
    sizes = materialize(sizes.withColumn("base", F.coalesce(F.sum("parts").over(before), F.lit(0)).cast("int")), "cell-sizes")
    shard = (F.col("base") + F.pmod(F.xxhash64("vec_id", "vector", F.lit(1)), F.col("parts"))).cast("int")
    dealt = placed.join(sizes, ["dim", "cell"]).select("vec_id", "vector", "copies", shard.alias("shard"))
    return materialize(dealt.groupBy("shard").applyInPandas(_build, TREE), "trees")


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    k: int = K,
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
    block_shards: int = BLOCK_SHARDS,
) -> DataFrame:
    """The ``k`` best rows of ``vectors(vec_id, embedding)`` for every row of
    ``queries(vec_id, embedding)``: ``query_id, rank, vec_id, score``."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x * SCALE) == float("inf"))

    def usable(df: DataFrame) -> DataFrame:
        named = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
        return named.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", odd))

    copies = usable(vectors).groupBy("vec_id", "vector").agg(F.count(F.lit(1)).alias("copies"))
    trees = _shards(materialize(copies, "vectors"), shard_rows)
    asked = usable(queries).select(F.xxhash64("vec_id", "vector").alias("query_key"), F.col("vec_id").alias("query_id"), "vector")
    asked = materialize(asked.distinct(), "queries")

    q_blocks = max(1, -(-asked.count() // block_queries))
    q_block = F.pmod(F.xxhash64("query_key", F.lit(2)), F.lit(q_blocks)).alias("q_block")
    s_blocks = max(1, -(-trees.count() // block_shards))
    balls = materialize(trees.drop("tree"), "balls").select(
        "*", (F.pmod("shard", F.lit(s_blocks))).alias("s_block"), F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("q_block")
    )
    found: DataFrame | None = None
    seen: DataFrame | None = None
    for nr, limit in enumerate(ROUNDS):
        if found is None:
            now = asked.select("*", F.lit(NO_FLOOR).alias("floor"), F.array().cast("array<int>").alias("seen"))
        else:
            # At most k rows of each shard so far, and these shards are few.
            kth = found.groupBy("query_key").agg(F.get(F.sort_array(F.collect_list("score"), False), F.lit(k - 1)).alias("floor"))
            been = seen.groupBy("query_key").agg(F.collect_list("shard").alias("seen"))
            now = materialize(asked.join(been, "query_key").join(kth, "query_key", "left").select(*asked.columns, F.coalesce("floor", F.lit(NO_FLOOR)).alias("floor"), "seen"), "floors")
        spread = now.select("*", q_block, F.explode(F.sequence(F.lit(0), F.lit(s_blocks - 1))).alias("s_block"))
        routes = spread.groupBy("s_block", "q_block").cogroup(balls.groupBy("s_block", "q_block")).applyInPandas(_routes(limit), ROUTE)
        if limit:
            best = Window.partitionBy("query_key").orderBy(F.desc("reach"), F.asc("shard"))
            routes = routes.withColumn("nr", F.row_number().over(best)).where(F.col("nr") <= limit)
        routes = materialize(routes.select("query_key", "shard"), f"routes-{nr}")
        seen = routes if seen is None else seen.unionByName(routes)
        # As many blocks per shard as its queries need.
        parts = routes.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / block_queries).cast("int").alias("parts"))
        block = F.pmod(F.xxhash64("query_key", F.lit(3)), F.col("parts")).alias("block")
        asking = routes.join(parts, "shard").select("query_key", "shard", block).join(now.drop("seen"), "query_key")
        copied = trees.join(parts, "shard").select("shard", "tree", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("block"))
        answers = (
            copied.select("shard", F.col("block").cast("long").alias("block"), "tree")
            .groupBy("shard", "block")
            .cogroup(asking.groupBy("shard", "block"))
            .applyInPandas(_answer(k), FOUND)
        )
        answers = materialize(answers, f"answers-{nr}")
        found = answers if found is None else found.unionByName(answers)
    best = Window.partitionBy("query_key", "query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
