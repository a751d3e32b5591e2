"""The corpus pipeline: documents to token files.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps
(the last one: what its token files hold). ``run`` writes every stage's result
as Parquet in the shared checkpoint folder and hands the next stage what it
reads back, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stepwise.llm.decontam import drop_contaminated
from stepwise.llm.language import keep_identified
from stepwise.llm.mixing import mixed_documents
from stepwise.llm.scratch import materialize, read_table
from stepwise.llm.simhash import RADIUS, SHINGLE_WORDS, keep_one_per_group
from stepwise.llm.tokens import tokenize_documents


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified as one of the wanted ones."""
    return keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicate fingerprints."""
    return keep_one_per_group(docs, shingle=SHINGLE_WORDS, radius=RADIUS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights takes them."""
    return mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and per document what they hold."""
    import public_tokenizers

    return tokenize_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

#: Fingerprint groups, fitted models and tokenizers are not SQL; the stages are
#: tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    *firsts, (_, last) = STAGES
    for name, stage in firsts:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return last(spark, docs, sf_dir)
