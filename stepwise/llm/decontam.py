"""Benchmark decontamination by winnowing (operator 10; DataFrame only).

Words are lower-cased (A-Z) runs of ASCII letters, digits and everything
beyond ASCII. Of every ``WINDOW - GRAM + 1`` consecutive ``GRAM``-word hashes
the smallest is kept (the leftmost of equals). What is kept depends on the
window's words alone, so any ``WINDOW`` words that a document shares with a
benchmark item leave the same fingerprint, at the same place, on both sides:
no shared span of that length is missed, while about two in seven hashes are
kept. The fingerprints of both sides are joined; each meeting is extended by
comparing the words of every window around it, so a hash collision never
counts.

Items of fewer than ``WINDOW`` words (but not none) are one window as a whole;
for each length among them the documents' word sequences of that length are
joined to them. That is at most ``WINDOW - 1`` lengths, however many items.

The benchmark's fingerprints, with the words around them, are written once and
measured. Up to ``BROADCAST_BYTES`` they are broadcast, and a meeting is
verified where the document is read: no text is shuffled. A larger benchmark is
joined by shuffling (hash, place) of the documents' fingerprints, and the texts
of the documents that meet it are fetched by one more join.

(The outer ``explode`` is on purpose: the optimizer pushes the filter that it
infers from an inner one below the projections, and copies what they compute
into every lambda.)
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepwise.llm.scratch import materialize

WINDOW = 10
GRAM = 5
#: Low bits of a fingerprint that hold its place (more than a string has
#: words); the rest is the hash.
PLACE_BITS = 30
#: The benchmark's fingerprints are broadcast up to this size.
BROADCAST_BYTES = 64 << 20

_DOC = ["doc_id", "text_hash"]

# Fixed value: what separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), SEPARATORS)
    return F.filter(parts, lambda w: w != "")


def _with_prints(df: DataFrame) -> DataFrame:
    """Adds ``prints``: the kept fingerprints of ``words``, each a hash (high
    bits) over its word place (low bits; ties go to the left)."""
    grams = ", ".join(f"words[i + {k}]" for k in range(GRAM))
    place = (1 << PLACE_BITS) - 1
    run = WINDOW - GRAM + 1
    return df.withColumn(
        "grams",
        F.expr(
            f"if(size(words) >= {WINDOW}, transform(sequence(0, size(words) - {GRAM}),"
            f" i -> shiftleft(xxhash64({grams}), {PLACE_BITS}) | cast(i & {place} as bigint)), array())"
        ),
    ).withColumn(
        "prints",
        F.expr(
            f"if(size(grams) > 0, array_distinct(transform(sequence(1, size(grams) - {run - 1}),"
            f" i -> array_min(slice(grams, i, {run})))), cast(array() as array<bigint>))"
        ),
    ).drop("grams")


def _hash(fingerprint: str) -> Column:
    return F.shiftright(F.col(fingerprint), PLACE_BITS)


def _place(fingerprint: str) -> Column:
    return F.col(fingerprint).bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")


def _keyed(docs: DataFrame) -> DataFrame:
    """The columns an operator works on. A row is known by its id and the hash
    of its text, so null and repeated ids are told apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def _long_items(items: DataFrame) -> DataFrame:
    """One row per fingerprint of the benchmark: its hash, the item, the words
    around it and how many of them come before it."""
    around = WINDOW - GRAM
    return (
        _with_prints(items.where(F.size("words") >= WINDOW))
        .select("item", "words", F.explode_outer("prints").alias("p"))
        .where(F.col("p").isNotNull())
        .withColumn("at", _place("p"))
        .withColumn("before", F.least("at", F.lit(around)))
        .select(
            _hash("p").alias("hash"),
            "item",
            "before",
            F.expr(f"slice(words, at - before + 1, before + {WINDOW})").alias("context"),
        )
    )


def _exploded(docs: DataFrame, n: int | None, *kept: str) -> DataFrame:
    """``hash, at`` of the fingerprints (or of all ``n``-word sequences), with
    the ``kept`` columns."""
    if n is None:
        prints = _with_prints(docs).select(*kept, F.explode_outer("prints").alias("p"))
        return prints.where(F.col("p").isNotNull()).select(*kept, _hash("p").alias("hash"), _place("p").alias("at"))
    sequences = F.expr(
        f"if(size(words) >= {n}, transform(sequence(1, size(words) - {n - 1}), i -> xxhash64(slice(words, i, {n}))), array())"
    )
    # The array is a column of its own first: only then is the generator compiled, and passes the words on by reference.
    each = docs.withColumn("sequences", sequences).select(*kept, F.posexplode_outer("sequences").alias("at", "hash"))
    return each.where(F.col("hash").isNotNull())


def _near(df: DataFrame) -> DataFrame:
    """The words of the document beside the benchmark's at a meeting, in place
    of all its words."""
    first = F.greatest(F.col("at") - F.col("before"), F.lit(0))
    near = F.slice("words", first + 1, F.size("context"))
    return df.select(*_DOC, "item", (F.col("at") - F.col("before")).alias("start"), "context", near.alias("near"))


def _windows() -> Column:
    """The windows of the item around a meeting that are the document's, word
    by word; a meeting at the head of a text has fewer words before it."""
    n, skipped = f"least({WINDOW}, size(context))", "greatest(-start, 0)"
    return F.expr(
        f"transform(filter(sequence({skipped}, greatest(size(context) - {n}, {skipped})),"
        f" s -> s - {skipped} + {n} <= size(near) and s + {n} <= size(context)"
        f" and slice(near, s - {skipped} + 1, {n}) = slice(context, s + 1, {n})),"
        f" s -> named_struct('item', item, 'at', start + s, 'n', {n}))"
    )


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, *, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``doc_id, text_hash, hits`` for documents with a hit; ``hits`` is an
    array of (item, at, n): ``n`` words from word ``at`` (from 0) are a window
    of ``item``."""
    items = materialize(
        benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("words")).distinct(),
        "benchmark",
    )
    with_words = _keyed(docs).withColumn("words", words(F.col("text"))).drop("text")
    short = items.where(F.size("words").between(1, WINDOW - 1)).withColumn("n", F.size("words"))
    sides = [(None, materialize(_long_items(items), "benchmark-prints"))]
    for n in sorted(r.n for r in short.select("n").distinct().collect()):  # at most WINDOW - 1
        own = short.where(F.col("n") == n)
        sides.append((n, own.select(F.xxhash64("words").alias("hash"), "item", F.lit(0).alias("before"), F.col("words").alias("context"))))
    met = []
    for n, side in sides:
        # The size of the side in memory, from its words; it is a sum over the benchmark only.
        size = side.agg(F.sum(F.length(F.array_join("context", " ")) + 16 * F.size("context") + 64)).first()[0] or 0
        if size <= broadcast_bytes:
            met.append(_near(_exploded(with_words, n, *_DOC, "words").join(F.broadcast(side), "hash")))
            continue
        meets = _exploded(with_words, n, *_DOC).join(side, "hash")
        by_doc = materialize(
            meets.groupBy(*_DOC).agg(F.collect_set(F.struct("item", "at", "before", "context")).alias("meets")), "meetings"
        )
        beside = by_doc.select(*[F.col(c).alias(f"_{c}") for c in _DOC], "meets").hint("merge")
        on = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_text_hash"))
        again = with_words.join(beside, on).select(*_DOC, "words", F.explode_outer("meets").alias("meet"))
        met.append(_near(again.select(*_DOC, "words", "meet.*")))
    found = reduce(DataFrame.unionByName, met).select(*_DOC, F.explode_outer(_windows()).alias("hit"))
    hits = found.where(F.col("hit").isNotNull()).select(*_DOC, "hit.*").distinct()
    return materialize(hits.groupBy(*_DOC).agg(F.collect_list(F.struct("item", "at", "n")).alias("hits")), "hits")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id, n_words, n_hit, n_items,
    items_sha256, contaminated``, against ``benchmark(item_id, text)``.

    Defined results: a null or empty text has no words and no hits; an item
    without words has no window; items of one id are one item, a null item id
    counts as an item but is not listed in the digest; rows of equal id and
    text each get their row; an empty side gives no hits; other columns are
    ignored.
    """
    found = benchmark_hits(docs, benchmark).select(
        F.col("doc_id").alias("_doc_id"),
        F.col("text_hash").alias("_text_hash"),
        F.expr("size(array_distinct(flatten(transform(hits, h -> sequence(h.at, h.at + h.n - 1)))))").alias("hit_words"),
        F.expr("array_sort(array_distinct(transform(hits, h -> h.item)))").alias("items"),
    )
    rows = docs.select(
        "doc_id",
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash"),
        F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long").alias("n_words"),
    )
    on = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_text_hash"))
    none = F.lit(0).cast("long")
    return rows.join(found, on, "left").select(
        "doc_id",
        "n_words",
        F.coalesce(F.col("hit_words").cast("long"), none).alias("n_hit"),
        F.when(F.col("items").isNotNull(), F.size("items")).otherwise(none).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        F.col("hit_words").isNotNull().alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a hit, with all their columns."""
    hit = benchmark_hits(docs, benchmark).select(
        F.col("doc_id").alias("_llm_doc_id"), F.col("text_hash").alias("_llm_text_hash")
    )
    text_hash = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    on = docs["doc_id"].eqNullSafe(F.col("_llm_doc_id")) & (text_hash == F.col("_llm_text_hash"))
    return docs.join(hit, on, "left_anti")
