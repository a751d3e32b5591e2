"""The queries of this subpackage, by name (``__spark_entry__`` adds them)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepwise.llm import statements
from stepwise.llm.bpe import decode_blocks, encode_blocks
from stepwise.llm.decontam import contamination
from stepwise.llm.divergence import divergence
from stepwise.llm.language import fit, identify, page_columns
from stepwise.llm.lines import dedup_lines
from stepwise.llm.mixing import mix
from stepwise.llm.periodic import longest, periodic_runs
from stepwise.llm.pii import pii_key, pseudonymized
from stepwise.llm.repeats import remove_repeats
from stepwise.llm.scratch import read_table
from stepwise.llm.secrets import BASE_KINDS, KINDS, counted, find_secrets, listed
from stepwise.llm.simhash import simhash_groups
from stepwise.llm.topk import top_k
from stepwise.llm.tokens import tokenize_documents


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of ``documents``, and per document what they hold."""
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents")
    return tokenize_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text of ``documents``."""
    found = find_secrets(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("secrets")
    return found.select(
        "doc_id",
        *[counted(spans, kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(listed(spans, BASE_KINDS).cast("binary"), 256).alias("base_sha256"),
        listed(spans, KINDS).alias("spans"),
    )


def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of ``documents`` in passages of 100 bytes that occur earlier."""
    cut = remove_repeats(read_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of the sources at target weights takes of each document."""
    plan = mix(read_table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document and page: fitted on the documents' labels;
    a document's label is its declaration and its source the host."""
    docs = read_table(spark, sf_dir, "documents")
    none = F.lit(None).cast("long")
    texts = docs.select("doc_id", none.alias("page_id"), F.col("lang").alias("declared"), F.col("source").alias("host"), "text")
    pages = page_columns(read_table(spark, sf_dir, "pages")).select(none.alias("doc_id"), "page_id", "declared", "host", "text")
    model = fit(docs.select("text", F.col("lang").alias("label")))
    return identify(texts.unionByName(pages), model)


def op6_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of ``documents`` by fingerprints within 3 bits."""
    groups = simhash_groups(read_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with one line of each group of similar lines."""
    return dedup_lines(read_table(spark, sf_dir, "documents"))


def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 rows of ``embeddings`` of the highest inner product with each row
    whose id is divisible by 50."""
    vectors = read_table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op9_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with personal data replaced by pseudonyms."""
    return pseudonymized(read_table(spark, sf_dir, "documents"), pii_key(spark))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents`` inside windows of ``benchmark`` items."""
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of a language of ``documents`` lie apart."""
    return divergence(read_table(spark, sf_dir, "documents"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of ``documents`` by the merge ranks, and the bytes they stand for."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    blocks = encode_blocks(read_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    spelt = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decode_blocks(blocks, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(spelt.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def with_periods(docs: DataFrame) -> DataFrame:
    """``docs`` with every tenth text (by a checksum of the id) continued from
    some word on by repeats of a stretch of its own words."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string"))
    parts = docs.withColumns({"_words": F.when(h % 10 == 0, words), "_g": F.floor(h / 10)}).withColumn("_n", F.size("_words"))
    turned = F.expr(
        """array_join(transform(_words, (w, i) -> if(
            i >= _g % _n, _words[cast(_g % _n + (i - _g % _n) % (1 + (_n - _g % _n) div (3 + _g % 8)) as int)], w)), ' ')"""
    )
    return parts.select("doc_id", F.when(F.col("_n") > 0, turned).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of ``documents``, and the texts without repeats."""
    found = periodic_runs(with_periods(read_table(spark, sf_dir, "documents"))).withColumn("top", longest("runs"))
    listed_runs = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(listed_runs, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
        "n_words",
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_output": op1_token_output,
        "op2_secret_scan": op2_secret_scan,
        "op3_repeated_passages": op3_repeated_passages,
        "op4_source_mixing": op4_source_mixing,
        "op5_language_id": op5_language_id,
        "op6_simhash_groups": op6_simhash_groups,
        "op7_line_dedup": op7_line_dedup,
        "op8_topk_search": op8_topk_search,
        "op9_pii_pseudonyms": op9_pii_pseudonyms,
        "op10_decontamination": op10_decontamination,
        "op11_source_divergence": op11_source_divergence,
        "op12_byte_bpe": op12_byte_bpe,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op8_topk_search": statements.OP8,
        "op10_decontamination": statements.OP10,
        "op11_source_divergence": statements.OP11,
    }
