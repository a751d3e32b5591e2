"""Source divergence audit (operator 11).

How far the word use of the sources of a language lies apart, and which words
set a source off from its language.

* Tokenizer: one ``bytes.translate`` per document turns A-Z to a-z and every
  other ASCII byte but a-z to a blank, ``bytes.split`` cuts, and a ``Counter``
  per document gives the words and how often they occur. Bytes from 0x80 are
  kept, so a term is a run of letters a-z and characters beyond ASCII.
* A task adds its documents up per language and term in a memory of bounded
  bytes and hands on what it holds when that is full: one row per term with its
  documents and its counts by source, however often a term occurs. These rows
  are written; from them a language keeps the terms that ``min_docs`` of its
  documents hold, and only of these the counts by source are taken apart.
* Shares are integers: ``p = 1 + floor(SCALE * (count + PRIOR) / (N + PRIOR *
  V))`` of the N occurrences of V kept terms, in decimals of 38 digits.
* ``pair``: the distance of two sources is the sum of ``|p - q|`` over all kept
  terms. The sum stays sparse: terms that neither source holds all add the same,
  ``|p0 - q0|`` with the shares of a count of 0, so V times that is corrected by
  the terms that either holds. Terms are cut in chunks of about ``CHUNK_TERMS``
  and sources in blocks of ``BLOCK_SOURCES``; a row carries the cells of one
  chunk in two blocks, numpy adds up all pairs of their sources, and the chunks'
  sums are aggregated. Rows are bounded whatever the number of terms or sources.
* ``term``: the terms whose share in a source is above the language's share.

Defined results: null ``text``, ``lang`` and ``source`` are empty strings, as
such a language and source like others; a repeated row is one more document; a
source without terms has a count of 0 for each kept term; a language without
kept terms has distances of 0 and no ``term`` rows; a source without another one
in its language has no ``pair`` rows; ties go to the smaller item in UTF-8
order; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepwise.llm.components import split_join
from stepwise.llm.scratch import materialize

MIN_DOCS = 30
PRIOR = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
#: Bytes of counts that a task holds, with so many bytes per term; terms of a batch that it hands on.
HELD_BYTES, ENTRY_BYTES, ROWS = 160 << 20, 160, 1 << 16
CHUNK_TERMS, BLOCK_SOURCES = 512, 64

FOLD = bytes(c | 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

_COUNTS = "lang string, term binary, docs long, sources array<string>, counts array<long>"


def terms(text: bytes) -> Counter:
    """The terms of one document and how often they occur."""
    return Counter(text.translate(FOLD).split())


class _Language:
    """Counts of one language: terms and sources by number, and per document
    and term a number of the source, of the term, and how often it occurs."""

    def __init__(self) -> None:
        self.terms: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
        self.sources: defaultdict[str, int] = defaultdict(itertools.count().__next__)
        self.held: list[tuple[int, np.ndarray, np.ndarray]] = []

    def add(self, source: str, text: bytes) -> int:
        """Counts a document; the bytes that it adds."""
        own, before = terms(text), len(self.terms)
        numbers = np.fromiter(map(self.terms.__getitem__, own), np.int64, len(own))
        self.held.append((self.sources[source], numbers, np.fromiter(own.values(), np.int64, len(own))))
        new = len(self.terms) - before
        return 16 * len(own) + ENTRY_BYTES * (1 + new) + sum(map(len, itertools.islice(reversed(self.terms), new)))

    def rows(self, lang: str) -> Iterator[pa.RecordBatch]:
        names, n = pa.array(list(self.sources)), len(self.sources)
        sizes = [len(x) for _, x, _ in self.held]
        cell = np.concatenate([x for _, x, _ in self.held]) * n + np.repeat([s for s, _, _ in self.held], sizes)
        order = np.argsort(cell, kind="stable")
        cell, times = cell[order], np.concatenate([t for _, _, t in self.held])[order]
        first = np.flatnonzero(np.diff(cell, prepend=-1))
        counts = np.add.reduceat(times, first) if len(first) else times
        cell, docs = cell[first], np.diff(np.append(first, len(cell)))  # a document has one entry per term
        of = np.searchsorted(cell, np.arange(len(self.terms) + 1) * n)
        total = np.concatenate(([0], np.cumsum(docs)))[of]
        yield self._batch(lang, [None], np.zeros(1, np.int64), np.array([0, n]), names, np.zeros(n, np.int64))
        held = list(self.terms)
        for at in range(0, len(held), ROWS):
            part = of[at : at + ROWS + 1]
            inside = slice(part[0], part[-1])
            yield self._batch(
                lang, held[at : at + ROWS], np.diff(total[at : at + ROWS + 1]), part - part[0], names.take(pa.array(cell[inside] % n)), counts[inside]
            )

    @staticmethod
    def _batch(lang: str, names: list, docs: np.ndarray, offsets: np.ndarray, sources: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
        at = pa.array(offsets.astype("i4"))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(names), pa.string()),
                pa.array(names, pa.binary()),
                pa.array(docs, pa.int64()),
                pa.ListArray.from_arrays(at, sources),
                pa.ListArray.from_arrays(at, pa.array(counts, pa.int64())),
            ],
            names=["lang", "term", "docs", "sources", "counts"],
        )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per (language, term): documents, and counts by source; a row without a
    term for each language lists the sources that occur."""
    held: defaultdict[str, _Language] = defaultdict(_Language)
    size = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
            size += held[lang].add(source, text)
            if size > HELD_BYTES:
                for name, language in held.items():
                    yield from language.rows(name)
                held.clear()
                size = 0
    for name, language in held.items():
        yield from language.rows(name)


def _share(count: str, total: str, kept: str) -> Column:
    return F.expr(f"1 + (cast({SCALE} as decimal(10,0)) * ({count} + {PRIOR})) div ({total} + {PRIOR} * {kept})")


def _pair_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of two blocks of sources (``a_sources``, ``a_base``) and their cells in
    one chunk of terms (``a_at`` source, ``a_term``, ``a_p``): the sum of
    ``|p - q| - |p0 - q0|`` per pair, and ``constant`` times ``|p0 - q0|``."""
    for batch in batches:
        for r in batch.itertuples():
            held = [t for cells in (r.a_term, r.b_term) if cells is not None for t in cells]
            number, names = pd.factorize(np.array(held, dtype=object))
            sides, at = [], 0
            for base, where, share in ((r.a_base, r.a_at, r.a_p), (r.b_base, r.b_at, r.b_p)):
                table = np.tile(np.asarray(base, np.int64), (len(names), 1))
                if where is not None:
                    table[number[at : at + len(where)], np.asarray(where)] = share
                    at += len(where)
                sides.append((np.asarray(base, np.int64), table))
            (base_a, a), (base_b, b) = sides
            out = []
            for i, own in enumerate(base_a):
                apart = np.abs(own - base_b)
                out.append(np.abs(a[:, i : i + 1] - b).sum(axis=0) + (r.constant - len(names)) * apart)
            sums = np.stack(out)
            i, j = np.nonzero(np.triu(np.ones_like(sums), 1) if r.same else np.ones_like(sums))
            yield pd.DataFrame({
                "lang": r.lang,
                "one": np.asarray(r.a_sources, dtype=object)[i],
                "other": np.asarray(r.b_sources, dtype=object)[j],
                "value": sums[i, j],
            })


def _pairs(groups: DataFrame, cells: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for all ordered pairs of sources of a
    language. ``groups(lang, source, kept, base)``, ``cells(lang, source, term, p)``."""
    by_name = Window.partitionBy("lang").orderBy("source")
    numbered = groups.withColumn("nr", F.row_number().over(by_name) - 1).select(
        "lang",
        "source",
        "base",
        F.expr(f"nr div {BLOCK_SOURCES}").alias("block"),
        F.expr(f"nr % {BLOCK_SOURCES}").alias("at"),
        F.expr(f"greatest(1, (kept + {CHUNK_TERMS - 1}) div {CHUNK_TERMS})").alias("chunks"),
        "kept",
    )
    numbered = materialize(numbered, "sources")
    placed = split_join(cells, numbered.select("lang", "source", "block", "at", "chunks"), ["lang", "source"])
    chunk = F.pmod(F.xxhash64("term"), F.col("chunks")).alias("chunk")
    packed = materialize(
        placed.select("lang", "block", chunk, F.struct("at", "term", "p").alias("cell"))
        .groupBy("lang", "chunk", "block")
        .agg(F.collect_list("cell").alias("cells")),
        "chunks",
    )
    blocks = numbered.groupBy("lang", "block", "chunks", "kept").agg(
        F.sort_array(F.collect_list(F.struct("at", "source", "base"))).alias("held")
    )

    def side(name: str) -> list[Column]:
        return [
            F.col("block").alias(f"{name}_block"),
            F.col("held.source").alias(f"{name}_sources"),
            F.col("held.base").alias(f"{name}_base"),
        ]

    def cells_of(name: str) -> DataFrame:
        parts = [F.col(f"cells.{c}").alias(f"{name}_{c}") for c in ("at", "term", "p")]
        return packed.select("lang", "chunk", F.col("block").alias(f"{name}_block"), *parts)

    # One row per chunk and pair of blocks.
    both = blocks.select("lang", "chunks", "kept", *side("a")).join(blocks.select("lang", *side("b")), "lang")
    both = both.where(F.col("a_block") <= F.col("b_block")).select(
        "*", F.explode(F.expr("sequence(0L, chunks - 1)")).alias("chunk"), (F.col("a_block") == F.col("b_block")).alias("same")
    )
    both = both.withColumn("constant", F.when(F.col("chunk") == 0, F.col("kept")).otherwise(0))
    for name in ("a", "b"):
        both = both.join(cells_of(name), ["lang", "chunk", f"{name}_block"], "left")
    sums = (
        both.mapInPandas(_pair_sums, "lang string, one string, other string, value long")
        .groupBy("lang", "one", "other")
        .agg(F.sum("value").alias("value"))
    )
    ends = F.array(*[F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in (("one", "other"), ("other", "one"))])
    return sums.select("lang", F.explode(ends).alias("end"), "value").select("lang", "end.*", "value")


def divergence(docs: DataFrame, *, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank`` of ``docs(text, lang, source)``."""
    texts = docs.select(
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    counts = materialize(texts.mapInArrow(_count, _COUNTS), "term-counts")
    known = F.col("term").isNotNull()
    often = counts.where(known).groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    often = materialize(often.select("lang", "term"), "kept-terms")
    # Counts by source are taken apart for kept terms only.
    apart = split_join(counts.where(known).drop("docs"), often, ["lang", "term"]).select(
        "lang", "term", F.inline(F.arrays_zip(F.col("sources").alias("source"), F.col("counts").alias("n")))
    )
    own = materialize(apart.groupBy("lang", "source", "term").agg(F.sum("n").alias("n")), "kept-counts")
    kept = materialize(own.groupBy("lang", "term").agg(F.sum("n").alias("lang_n")), "kept-totals")
    languages = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    groups = (
        counts.where(~known)
        .select("lang", F.explode("sources").alias("source"))
        .distinct()
        .join(own.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        .join(languages, "lang", "left")
        .select(
            "lang", "source",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "kept", "lang_total")],
        )
    )
    base = F.coalesce(_share("0L", "total", "nullif(kept, 0)"), F.lit(0)).cast("long")
    groups = materialize(groups.withColumn("base", base), "groups")
    cells = materialize(
        split_join(split_join(own, kept, ["lang", "term"]), groups, ["lang", "source"]).select(
            "lang", "source", F.col("term").cast("string").alias("term"),
            _share("n", "total", "kept").cast("long").alias("p"),
            _share("lang_n", "lang_total", "kept").cast("long").alias("q"),
        ),
        "shares",
    )
    pairs = _pairs(groups.select("lang", "source", "kept", "base"), cells.select("lang", "source", "term", "p"))
    apart = cells.where(F.col("p") > F.col("q")).select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = F.row_number().over(order).alias("rank")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.select("*", F.lit("pair").alias("part"), ranked)
        .select(*columns)
        .unionByName(apart.select("*", F.lit("term").alias("part"), ranked).where(F.col("rank") <= top_terms).select(*columns))
    )
