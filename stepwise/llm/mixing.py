"""Mixing sources to target weights by weighted fair queueing (operator 4;
DataFrame only).

Every document enters its source's queue in a shuffled order. Its virtual
finish time is the source's words up to and with it, divided by the source's
target; a source that gives more than it has goes through its queue again.
Ordered by finish time over all sources, the queue serves every source at its
weight at any point; it is cut where its total reaches the budget.

Targets: the budget (``share`` of all words) is dealt by weight, a source's
target stops at ``most`` times its words, and the excess is dealt again until
none is above. The sources taken in order of the level at which each of them
is full, that level is found by running totals over the sources.

Nothing depends on how many rows a source has: both running totals (inside
the sources, and over the queue) are range-partitioned on the full order, so
a source with a third of all rows is spread like any other rows.

Defined results: a null or empty text has size 0, takes part and takes no words;
null sources are one source, the last one; rows equal in id, text and source
are taken together, equally often; with no words at all every target is 0 and
nothing is taken but rows of size 0; an empty table gives no rows; other
columns are ignored by ``mix`` and kept by ``mixed_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepwise.llm.running import running_totals
from stepwise.llm.scratch import materialize

#: Weights of the sources in code point order, repeated as needed.
WEIGHTS = (5, 2, 1)
#: Budget as a share of all words, and the most that a source gives of its own.
SHARE = 1.5
MOST = 2
SEED = 0

# Fixed value: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
_KEY = ["doc_id", "text_hash", "no_source", "source"]


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        F.xxhash64(text).alias("text_hash"),
        F.col("source").isNull().alias("no_source"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
    )


def source_targets(units: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """``no_source, source, source_size, target, start``; ``start`` is the
    words of all sources before this one."""
    sources = units.groupBy("no_source", "source").agg(F.sum("size").alias("source_size"))
    ranked = running_totals(
        sources.withColumn("one", F.lit(1).cast("long")), ["no_source", "source"], {"rank": "one", "upto": "source_size"}
    )
    weighed = ranked.select(
        "no_source",
        "source",
        "source_size",
        (F.col("upto") - F.col("source_size")).alias("start"),
        F.get(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights)).cast("int")).cast("long").alias("weight"),
        (F.col("source_size") * most).alias("full"),
    ).withColumn("level", F.col("full") / F.col("weight"))
    filled = materialize(
        running_totals(weighed, ["level", "no_source", "source"], {"full_upto": "full", "weight_upto": "weight"}),
        "sources",
    )
    # What is left for this source and those that fill later, by weight; the
    # level of the first source for which that doesn't fill it holds for all.
    total, weight = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    left = F.lit(share * (total or 0)) - (F.col("full_upto") - F.col("full"))
    fair = left / (F.lit(weight) - F.col("weight_upto") + F.col("weight"))
    found = filled.where(fair <= F.col("level")).agg(F.min_by(fair, F.struct("level", "no_source", "source"))).first()[0]
    target = F.col("full").cast("double")
    if found is not None:
        target = F.least(target, F.lit(found) * F.col("weight"))
    return filled.select("no_source", "source", "source_size", target.alias("target"), "start")


def _queue(docs: DataFrame, weights: tuple[int, ...], share: float, most: int, seed: int) -> DataFrame:
    """``_KEY, size, source_size, target, copies`` for each distinct unit."""
    rows = materialize(_keyed(docs).groupBy(*_KEY, "size").agg(F.count(F.lit(1)).alias("rows")), "units")
    units = rows.withColumn("words", F.col("size") * F.col("rows"))
    units = units.drop("size").withColumnRenamed("words", "size")
    targets = materialize(source_targets(units, weights, share, most), "targets")
    shuffled = units.withColumn("turn", F.xxhash64(F.lit(seed), "doc_id", "text_hash"))
    order = ["no_source", "source", "turn", "doc_id", "text_hash"]
    summed = running_totals(shuffled, order, {"upto": "size"}).join(targets, ["no_source", "source"])
    rounds = F.explode(F.array(*[F.lit(r) for r in range(most)])).alias("round")
    served = (F.col("round") * F.col("source_size") + F.col("upto") - F.col("start")) / F.col("target")
    entries = (
        summed.where((F.col("target") > 0) | (F.col("size") == 0))
        .select("*", rounds)
        .withColumn("finish", F.when(F.col("target") > 0, served).otherwise(0.0))
        .where((F.col("target") > 0) | (F.col("round") == 0))
    )
    queue = running_totals(entries, ["finish", *order, "round"], {"total": "size"})
    budget = F.lit(share) * F.lit(targets.agg(F.sum("source_size")).first()[0] or 0)
    taken = queue.where(F.col("total") <= budget).groupBy(*_KEY).agg(F.count(F.lit(1)).alias("copies"))
    known = rows.join(targets.drop("start"), ["no_source", "source"])
    on = _same(known, taken)
    return known.join(taken, on, "left").select(
        *[known[c] for c in _KEY], "size", "source_size", "target", F.coalesce("copies", F.lit(0)).cast("long").alias("copies")
    )


def _same(a: DataFrame, b: DataFrame) -> Column:
    out = a[_KEY[0]].eqNullSafe(b[_KEY[0]])
    for c in _KEY[1:]:
        out = out & (a[c] == b[c])
    return out


def mix(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED) -> DataFrame:
    """Per row of ``docs(doc_id, text, source)``: ``doc_id, size, source_size,
    target, copies`` (how often the mix takes it)."""
    plan = materialize(_queue(docs, weights, share, most, seed), "mix")
    rows = _keyed(docs).drop("size")
    return rows.join(plan, _same(rows, plan)).select(
        rows["doc_id"], plan["size"], "source_size", "target", "copies"
    )


def mixed_documents(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    plan = materialize(_queue(docs, weights, share, most, seed).where(F.col("copies") > 0), "mix")
    again = plan.select(*[F.col(c).alias(f"_mix_{c}") for c in _KEY], F.col("copies").alias("_mix_copies"))
    on = (
        docs["doc_id"].eqNullSafe(F.col("_mix_doc_id"))
        & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col("_mix_text_hash"))
        & (docs["source"].isNull() == F.col("_mix_no_source"))
        & (F.coalesce(docs["source"].cast("string"), F.lit("")) == F.col("_mix_source"))
    )
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mix_copies"))).alias("_mix_copy")
    return docs.join(again, on).select(*[docs[c] for c in docs.columns], copies).drop("_mix_copy")
