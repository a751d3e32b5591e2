"""SimHash near-duplicates (operator 6).

Fingerprints of 64 bits are linked when they differ in at most ``radius``
bits; documents of one connected group of links are near-duplicates.

Fingerprint: words are runs of non-white-space (ASCII) after lower-casing A-Z;
every ``shingle``-word sequence, repeats included, votes with the bits of its
XXH64 (seed 42); a bit is 1 if set in over half the votes. A text of fewer
words votes with its whole sequence; one without words has fingerprint zero.

Search, meeting in the middle: two words at distance ``2 h`` have a common
word within ``h`` of both, so every fingerprint emits its whole ball of radius
``h = radius // 2`` and fingerprints that emit the same variant are compared.
For an odd radius one more differing bit has to go: the 64 bits are cut in
``BLOCKS`` blocks, and the ball is emitted once for every block left out. Of
``2 h + 1`` differing bits at least one lies in some block; with that block
left out ``2 h`` remain, and the balls meet. For radius 3 that is 4 x 49
variants a fingerprint instead of the 2,081 of a ball of radius 2. No link is
lost.

What meets on a variant is at distance ``2 h`` outside the block left out. So
fingerprints of equal block bits are certainly linked and are chained to the
smallest of them; these first ones (at most one for each value of the 16 bits)
are compared with each other, and so are those whose bits outside the block are
the key itself (a pair that differs in the block only meets as these), one for
each value of the 16 bits, too. A pair is kept if its distance, counted over
all 64 bits, is within the radius. Copies never meet: distinct
fingerprints are searched, and a document is mapped to the component of its
fingerprint.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepwise.llm.components import connected_components, split_join
from stepwise.llm.scratch import materialize, text_batches

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
BITS = 64
BLOCKS = 4
# A long text is hashed in pieces of about this many bytes.
PIECE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _pieces(data: bytes) -> Iterator[list[bytes]]:
    """The words of ``data``, a bounded number at a time."""
    at = 0
    while at < len(data):
        end = at + PIECE
        if end < len(data):
            gap = _SPACE.search(data, end)
            end = gap.start() if gap else len(data)
        yield data[at:end].split()
        at = end


def _votes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of every ``size``-word sequence of ``words`` (space-joined)."""
    from xxhash import xxh64_intdigest

    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = map(slice, starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
    n = len(words) - size + 1
    return np.fromiter(map(xxh64_intdigest, map(line.__getitem__, spans), repeat(SEED)), np.uint64, n)


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """The fingerprint of one text, as a signed 64-bit integer."""
    counts, total = np.zeros(BITS, np.int64), 0
    kept: list[bytes] = []
    for words in _pieces((text or "").encode("utf-8", "surrogatepass").lower()):
        kept += words
        if len(kept) >= size:
            votes = _votes(kept, size)
            bits = np.unpackbits(votes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
            total += len(votes)
            kept = kept[len(kept) - size + 1 :]
    if not total:
        if not kept:
            return 0
        return int(_votes(kept, len(kept)).view(np.int64)[0])
    ones = np.packbits(counts * 2 > total, bitorder="little")
    return int(ones.view(np.int64)[0])


def fingerprints(text: Column, size: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf("long")
    def each(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, size) for t in texts], dtype="int64")

    return each(text)


def _variants(prints: DataFrame, radius: int) -> DataFrame:
    """``key, fp``: the ball of radius ``radius // 2`` of every fingerprint,
    once per block left out if the radius is odd. A key holds the bits that
    are left, and the number of the block above them."""
    half, odd = divmod(radius, 2)
    width = BITS // BLOCKS if odd else 0
    left = BITS - width
    fp = F.col("fp")
    if odd:
        cut = []
        for j in range(BLOCKS):
            low = fp.bitwiseAND(F.lit((1 << (width * j)) - 1))
            high = F.shiftrightunsigned(fp, width * (j + 1)) if j + 1 < BLOCKS else F.lit(0).cast("long")
            cut.append(low.bitwiseOR(F.shiftleft(high, width * j)).bitwiseOR(F.lit(j << left)))
        prints = prints.select(fp, F.explode(F.array(*cut)).alias("cut"))
    else:
        prints = prints.select(fp, fp.alias("cut"))
    flips = [sum(1 << b for b in c) for n in range(half + 1) for c in combinations(range(left), n)]
    flips = [f - (1 << BITS) if f >> (BITS - 1) else f for f in flips]
    balls = prints.select(fp, "cut", F.explode(F.array(*[F.lit(f).cast("long") for f in flips])).alias("flip"))
    return balls.select(F.col("cut").bitwiseXOR(F.col("flip")).alias("key"), fp)


def _pairs(key: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among the fingerprints of each key; rows come sorted by key."""
    same = key[1:] == key[:-1]
    meets = np.concatenate((same, [False])) | np.concatenate(([False], same))
    key, fp = key[meets], fp[meets]
    if not len(key):
        return fp, fp
    block = np.zeros(len(fp), np.uint64)
    whole = np.zeros(len(fp), bool)
    if radius % 2:
        width = BITS // BLOCKS
        j = key.view(np.uint64) >> np.uint64(BITS - width)
        at, bits = j * np.uint64(width), fp.view(np.uint64)
        block = (bits >> at) & np.uint64((1 << width) - 1)
        # The cut of the fingerprint itself, as in _variants.
        high = np.where(j + np.uint64(1) < BLOCKS, bits >> np.minimum(at + np.uint64(width), np.uint64(BITS - 1)), np.uint64(0))
        cut = (bits & ((np.uint64(1) << at) - np.uint64(1))) | (high << at) | (j << np.uint64(BITS - width))
        whole = cut == key.view(np.uint64)
    order = np.lexsort((fp, block, key))
    key, fp, block, whole = key[order], fp[order], block[order], whole[order]
    first = np.concatenate(([True], (key[1:] != key[:-1]) | (block[1:] != block[:-1])))
    head = fp[np.flatnonzero(first)][np.cumsum(first) - 1]
    us, vs = [fp[~first]], [head[~first]]
    for some in (first, whole):
        keys, fps = key[some], fp[some]
        lag = 1
        while lag < len(keys):
            at = np.flatnonzero(keys[lag:] == keys[:-lag])
            if not len(at):
                break
            u, v = fps[at + lag], fps[at]
            near = np.bitwise_count(u.view(np.uint64) ^ v.view(np.uint64)) <= radius
            us.append(u[near])
            vs.append(v[near])
            lag += 1
    return np.concatenate(us), np.concatenate(vs)


def _linker(radius: int):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def emit(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        u, v = _pairs(key, fp, radius)
        pairs = np.unique(np.stack((np.maximum(u, v), np.minimum(u, v)), axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = fp = np.zeros(0, np.int64)
        for batch in batches:
            key = np.concatenate((key, batch.column("key").to_numpy(zero_copy_only=False)))
            fp = np.concatenate((fp, batch.column("fp").to_numpy(zero_copy_only=False)))
            if not len(key):
                continue
            last = int(np.searchsorted(key, key[-1]))  # the last key may go on in the next batch
            if last:
                yield emit(key[:last], fp[:last])
                key, fp = key[last:], fp[last:]
        if len(key):
            yield emit(key, fp)

    return link


def fingerprint_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``u > v`` between the distinct fingerprints ``fp`` of ``prints``
    whose closure is that of all pairs within ``radius`` bits."""
    met = _variants(prints, radius).repartition("key").sortWithinPartitions("key")
    return met.mapInArrow(_linker(radius), "u long, v long").distinct()


def simhash_groups(docs: DataFrame, *, shingle: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id, text_hash, fp, label,
    component_id``; ``label`` names the group by a fingerprint of it,
    ``component_id`` by its smallest ``doc_id``.

    Defined results: a null text is an empty one (fingerprint zero, linked
    like any other); null ids are members but never the smallest (a group of
    null ids only has a null ``component_id``); repeated rows each get their
    row; an empty table gives no rows; other columns are ignored.
    """
    printed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash"),
        fingerprints(F.col("text"), shingle).alias("fp"),
    )
    with text_batches(docs.sparkSession):
        rows = materialize(printed, "fingerprints")
    prints = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "distinct-fingerprints")
    nodes = materialize(connected_components(fingerprint_links(prints.select("fp"), radius)), "components")
    labelled = prints.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "smallest", F.coalesce("component", "fp").alias("label")
    )
    named = labelled.groupBy("label").agg(F.min("smallest").alias("component_id"))
    by_print = materialize(split_join(labelled.drop("smallest"), named, ["label"]), "components-by-fingerprint")
    return rows.join(by_print, "fp").select("doc_id", "text_hash", "fp", "label", "component_id")


def keep_one_per_group(docs: DataFrame, *, shingle: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the one
    with the smallest ``doc_id`` stays (nulls last; among rows of that id the
    one with the smallest text hash, and one of rows that are equal in both).
    """
    rows = materialize(simhash_groups(docs, shingle=shingle, radius=radius), "groups")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    best = split_join(rows, rows.groupBy("label").agg(F.min(rank).alias("best")), ["label"])
    # Rows to go, and the rows that stay where several are equal.
    counted = materialize(
        best.withColumn("stays", rank == F.col("best"))
        .groupBy("doc_id", "text_hash", "stays")
        .agg(F.count(F.lit(1)).alias("rows")),
        "decisions",
    )
    ids = ["_llm_id", "_llm_hash"]
    keyed = docs.withColumns({
        "_llm_id": F.col("doc_id").cast("long"),
        "_llm_hash": F.xxhash64(F.coalesce(F.col("text"), F.lit(""))),
    })

    def key_of(df: DataFrame) -> DataFrame:
        return df.select(F.col("doc_id").alias("_llm_of_id"), F.col("text_hash").alias("_llm_of_hash"))

    match = reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(ids, ["_llm_of_id", "_llm_of_hash"])])
    gone = key_of(counted.where(~F.col("stays") | (F.col("rows") > 1)))
    kept = keyed.join(gone, match, "left_anti").drop(*ids)
    tied = key_of(counted.where(F.col("stays") & (F.col("rows") > 1)))
    one = keyed.join(tied, match, "left_semi").dropDuplicates(ids).drop(*ids)
    return kept.unionByName(one)
