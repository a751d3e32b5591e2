"""Language identification by Bayesian evidence fusion (operator 5).

For each row the posterior of a language is the product of

* its text likelihood: a multinomial model of hashed byte trigrams over the
  whole text, fitted on labelled rows. Overlapping trigrams of one text are
  not independent, so the mean log-likelihood counts as ``n * EVIDENCE / (n +
  EVIDENCE)`` trigrams: in full for a few words, ever less for more. Every
  label that occurs is a language; ``und`` competes with them by a background
  model (half the mean of the fitted languages, half all trigrams alike), which
  explains text of none of them better than any one of them does;
* the declared language (markup ``lang`` attribute, or a metadata column):
  how often a declaration goes with texts of a language, from a grouped count
  of the whole corpus. Declarations that lie count for little;
* a prior for the host, smoothed by hierarchy: the shares of the languages at
  the host, shrunk to those of its address suffix, shrunk to those of the
  corpus, all from the same grouped count.

The counts use the text likelihood's own decision, over all rows. The model
(``BUCKETS`` x languages) is the only thing collected and broadcast; count
tables stay tables and are joined by key, with hot keys left to adaptive
execution.

A row is accepted if its text has letters, its language is one of the wanted
ones and the posterior reaches ``MIN_POSTERIOR``.

Defined results: labels are language codes of two or three letters, in either
case, with or without what follows a hyphen or underscore (``EN``, ``en-GB``);
other labels are not fitted; a null, empty or letterless text has language
``und`` and is not accepted, whatever was declared; a text that the background
explains best is ``und``, too, with the posterior of that; a null or unknown
declaration, host or suffix gives no evidence (its level of the prior is passed
over); repeated rows each get their row; an empty table gives no rows.
"""

from __future__ import annotations

import html
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepwise.llm.components import split_join
from stepwise.llm.scratch import materialize, text_batches

#: Languages that are accepted.
LANGUAGES = ("de", "en", "es", "fr")
UNKNOWN = "und"
#: Three-letter codes of these languages, and codes that stand for none.
ALIASES = {"deu": "de", "ger": "de", "eng": "en", "spa": "es", "fra": "fr", "fre": "fr"}
NO_LANGUAGE = (UNKNOWN, "mis", "mul", "zxx")
BUCKETS = 1 << 16
#: Bound of the fitting sample: about this many distinct labelled texts per language.
TRAIN_ROWS = 2000
#: A text never counts for more than this many independent trigrams.
EVIDENCE = 48.0
#: Added to every trigram count, to every declaration count; weight of the
#: level above in a prior.
SMOOTH, DECLARED_SMOOTH, SHRINK = 0.5, 1.0, 20.0
MIN_POSTERIOR = 0.5
#: Share of the fitted languages in the background; the rest is uniform.
POOLED = 0.5
# A long text is scored in pieces of about this many bytes.
PIECE = 1 << 20

_FOLD = bytes(c if chr(c).isalpha() and c < 128 or c >= 128 else 32 for c in range(256))


def _trigrams(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of the byte trigrams with a letter in the middle, a bounded
    number at a time."""
    data = b" " + (text or "").encode("utf-8", "surrogatepass").lower().translate(_FOLD) + b" "
    for at in range(0, len(data) - 2, PIECE):
        b = np.frombuffer(data, np.uint8, min(PIECE + 2, len(data) - at), at).astype(np.uint32)
        code = b[:-2] | (b[1:-1] << np.uint32(8)) | (b[2:] << np.uint32(16))
        yield (code[b[1:-1] != 32] * np.uint32(2654435761)) >> np.uint32(16)


def _entities(text: Column) -> Column:
    """Character references (``&eacute;``, ``&#233;``) as the characters they
    stand for; an ampersand, which is part of no word, as a blank."""

    @F.pandas_udf("string")
    def each(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: html.unescape(t.replace("&amp;", " ")) if t and "&" in t else t)

    return each(text)


def page_columns(pages: DataFrame) -> DataFrame:
    """``pages(url, html)`` with ``text``, ``declared``, ``host``: markup
    stripped, the ``lang`` attribute of the root element, the host. A comment,
    script or style that is never closed goes on to the end of the page, as in
    a browser, so no opener is searched for twice."""
    page = F.coalesce("html", F.lit(""))
    bare = F.regexp_replace(page, r"(?is)<(script|style)\b.*?(?:</\1\s*>|\z)|<!--.*?(?:-->|\z)|<[^<>]*>", " ")
    return pages.withColumns({
        "text": _entities(bare),
        "declared": F.regexp_extract(page, r"(?i)<html\b[^<>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1),
        "host": F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1),
    })


def _label(label: Column) -> Column:
    """An array of the language code of a label, empty if it is none. The code
    is a lambda's variable, so the pattern occurs once however often it is used."""
    code = F.regexp_extract(F.lower(F.trim(label)), r"^([a-z]{2,3})(?:[-_].*)?$", 1)
    own = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
    named = F.transform(F.array(code), lambda c: F.coalesce(F.try_element_at(own, c), c))
    return F.filter(named, lambda c: ~c.isin("", *NO_LANGUAGE))


def _sample(labelled: DataFrame, languages: tuple[str, ...] | None, rows: int) -> DataFrame:
    """About ``rows`` distinct texts per language: those with the smallest hashes."""
    # A generator, because filters on its output are not copied below it.
    known = labelled.select(F.explode_outer(_label(F.col("label"))).alias("label"), "text")
    known = known.where(F.col("label").isNotNull() & F.col("text").isNotNull())
    if languages is not None:
        known = known.where(F.col("label").isin(*languages))
    known = known.withColumn("hash", F.xxhash64("label", "text"))
    distinct = materialize(known.groupBy("label", "hash").agg(F.lit(1).alias("one")), "labelled-texts")
    # Codes of two or three letters: 18,252 rows at most.
    shares = F.broadcast(distinct.groupBy("label").agg((F.lit(float(rows)) / F.count(F.lit(1))).alias("share")))
    draw = F.pmod("hash", F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = distinct.join(shares, "label").where(draw < F.col("share")).select("label", "hash")
    # Drawn texts are few: at most about ``rows`` for each of the codes that occur.
    return known.join(materialize(drawn, "drawn"), ["label", "hash"]).groupBy("label", "hash").agg(F.first("text").alias("text"))


def fit(labelled: DataFrame, *, languages: tuple[str, ...] | None = None, rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """Log-probabilities of the buckets (rows) per language (columns), fitted
    on ``labelled(text, label)``: every language that is a label, or those of
    ``languages`` that are."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for label, text in zip(batch["label"], batch["text"]):
                sums = total.setdefault(label, np.zeros(BUCKETS, np.int64))
                for grams in _trigrams(text):
                    sums += np.bincount(grams, minlength=BUCKETS)
        for label, sums in total.items():
            at = np.flatnonzero(sums)
            yield pd.DataFrame({"label": label, "bucket": at.astype("int32"), "n": sums[at]})

    counted = (
        _sample(labelled, languages, rows)
        .select("label", "text")
        .mapInPandas(count, "label string, bucket int, n long")
        .groupBy("label", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # at most BUCKETS x languages
    )
    names = sorted(set(counted["label"]))
    table = np.full((BUCKETS, len(names)), SMOOTH)
    for j, name in enumerate(names):
        own = counted[counted["label"] == name]
        table[own["bucket"].to_numpy(), j] += own["n"].to_numpy()
    return names, np.log(table / table.sum(axis=0)).astype(np.float32) if names else table.astype(np.float32)


def _with_background(names: list[str], table: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The model with ``und`` as one more language."""
    pooled = np.exp(table.astype(np.float64)).mean(axis=1)
    background = np.log(POOLED * pooled + (1 - POOLED) / len(table))
    return [*names, UNKNOWN], np.column_stack((table, background)).astype(np.float32)


def _text_evidence(spark, text: Column, table: np.ndarray) -> Column:
    held = spark.sparkContext.broadcast(table)

    @F.pandas_udf("array<double>")
    def each(texts: pd.Series) -> pd.Series:
        scores = held.value
        out = []
        for text in texts:
            total, n = np.zeros(scores.shape[1]), 0
            for grams in _trigrams(text):
                total += scores[grams].sum(axis=0, dtype=np.float64)
                n += len(grams)
            out.append((total / n * (n * EVIDENCE / (n + EVIDENCE))).tolist() if n else None)
        return pd.Series(out)

    return each(text)


def _array(names: list[str], value) -> Column:
    return F.array(*[value(n) for n in names])


def _shares(counts: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Per key an array of row counts by language."""
    return counts.groupBy(*keys).agg(
        _array(names, lambda n: F.sum(F.when(F.col("text_language") == n, F.col("n")).otherwise(0)).cast("double")).alias("by")
    )


def _totals(counts: DataFrame, names: list[str]) -> list[float]:
    """Rows per language; no more numbers than there are languages."""
    return [n or 0.0 for n in _shares(counts, [], names).first()["by"]]


def _shrunk(by: str, above: Column) -> Column:
    total = F.aggregate(by, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(by, above, lambda x, p: (x + SHRINK * p) / (total + SHRINK))


def identify(
    rows: DataFrame,
    model: tuple[list[str], np.ndarray],
    *,
    wanted: tuple[str, ...] = LANGUAGES,
    min_posterior: float = MIN_POSTERIOR,
) -> DataFrame:
    """``rows(text, declared, host, ...)`` without ``text`` and with
    ``text_language, language, posterior, accepted``; other columns are kept
    (names that begin with ``_llm_`` are this operator's own)."""
    spark = rows.sparkSession
    names, table = model
    kept = [c for c in rows.columns if c != "text"]
    if not names:  # nothing to tell languages by
        nothing = F.lit(None).cast("string")
        return rows.select(
            *kept, nothing.alias("text_language"), F.lit(UNKNOWN).alias("language"),
            F.lit(0.0).alias("posterior"), F.lit(False).alias("accepted"),
        )

    names, table = _with_background(names, table)

    def top(scores: str) -> Column:
        return F.element_at(F.array(*map(F.lit, names)), F.array_position(scores, F.array_max(scores)).cast("int"))

    scored = rows.select(*kept, _text_evidence(spark, F.col("text"), table).alias("_llm_text")).withColumns({
        "text_language": F.when(F.col("_llm_text").isNotNull(), top("_llm_text")),
        "_llm_declared": F.lower(F.nullif(F.trim("declared"), F.lit(""))),
        "_llm_host": F.lower(F.nullif(F.trim("host"), F.lit(""))),
    }).withColumn("_llm_suffix", F.nullif(F.regexp_extract("_llm_host", r"\.([^.]+)$", 1), F.lit("")))
    with text_batches(spark):
        scored = materialize(scored, "text-evidence")
    counts = materialize(
        scored.where(F.col("text_language").isNotNull())
        .groupBy("_llm_declared", "_llm_suffix", "_llm_host", "text_language")
        .agg(F.count(F.lit(1)).alias("n")),
        "language-counts",
    )
    overall = _totals(counts, names)
    total = sum(overall)
    base = [(n + SHRINK / len(names)) / (total + SHRINK) for n in overall]
    corpus = F.array(*map(F.lit, base))
    said = counts.where(F.col("_llm_declared").isNotNull())
    kinds = said.select("_llm_declared").distinct().count()
    per_language = _totals(said, names)
    declared = _shares(said, ["_llm_declared"], names).select(
        "_llm_declared",
        F.zip_with(
            "by",
            F.array(*map(F.lit, per_language)),
            lambda x, n: F.log((x + DECLARED_SMOOTH) / (n + DECLARED_SMOOTH * max(kinds, 1))),
        ).alias("_llm_said"),
    )
    suffixes = _shares(counts.where(F.col("_llm_suffix").isNotNull()), ["_llm_suffix"], names).select(
        "_llm_suffix", _shrunk("by", corpus).alias("_llm_above")
    )
    hosts = (
        _shares(counts.where(F.col("_llm_host").isNotNull()), ["_llm_suffix", "_llm_host"], names)
        .join(suffixes, "_llm_suffix", "left")
        .select("_llm_host", _shrunk("by", F.coalesce("_llm_above", corpus)).alias("_llm_prior"))
    )
    fused = split_join(scored, materialize(declared, "declarations"), ["_llm_declared"], "left")
    fused = split_join(fused, materialize(hosts, "hosts"), ["_llm_host"], "left")
    prior = F.transform(F.coalesce("_llm_prior", corpus), lambda p: F.log(p))
    none = F.array(*[F.lit(0.0)] * len(names))
    joint = F.zip_with(
        F.zip_with(F.col("_llm_text"), prior, lambda a, b: a + b), F.coalesce("_llm_said", none), lambda a, b: a + b
    )
    out = fused.withColumn("_llm_joint", joint).withColumn(
        "_llm_norm",
        F.aggregate("_llm_joint", F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max("_llm_joint"))),
    )
    has_text = F.col("_llm_text").isNotNull()
    out = out.withColumns({
        "language": F.when(has_text, top("_llm_joint")).otherwise(UNKNOWN),
        "posterior": F.when(has_text, 1.0 / F.col("_llm_norm")).otherwise(0.0),
    })
    accepted = has_text & F.col("language").isin(*wanted) & (F.col("posterior") >= min_posterior)
    return out.withColumn("accepted", accepted).select(
        *kept, "text_language", "language", "posterior", "accepted"
    )


def keep_identified(docs: DataFrame, **options) -> DataFrame:
    """The accepted rows of ``docs(doc_id, text, lang, source)`` with all their
    columns, unchanged: ``lang`` is the label to fit by and the declaration,
    ``source`` the host."""
    model = fit(docs.select("text", F.col("lang").alias("label")))
    text_hash = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    rows = docs.select("doc_id", text_hash.alias("text_hash"), F.col("lang").alias("declared"), F.col("source").alias("host"), "text")
    told = identify(rows, model, **options)
    gone = materialize(told.where(~F.col("accepted")).drop("text_language", "language", "posterior", "accepted"), "rejected")
    gone = gone.select(*[F.col(c).alias(f"_llm_{c}") for c in gone.columns])
    on = (
        docs["doc_id"].eqNullSafe(F.col("_llm_doc_id"))
        & (text_hash == F.col("_llm_text_hash"))
        & docs["lang"].eqNullSafe(F.col("_llm_declared"))
        & docs["source"].eqNullSafe(F.col("_llm_host"))
    )
    return docs.join(gone, on, "left_anti")
