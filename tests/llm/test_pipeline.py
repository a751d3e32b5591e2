"""Every stage of the pipeline against a plain version, on its own input."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline as P
from stepwise.llm.scratch import materialize
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    import public_tokenizers

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    outs = {}
    for name, stage in P.STAGES:
        outs[name] = docs = materialize(stage(spark, docs, SF), name)

    def texts(name):
        return [(r.doc_id, r.text) for r in outs[name].collect()]

    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(outs[n].columns == columns for n, _ in P.STAGES[:-1])
    everything = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    identified = texts("language_id")
    assert set(identified) <= set(everything) and len(identified) >= 0.98 * len(everything)
    group = brute.components([(d, brute.simhash(t)) for d, t in identified])
    deduped = texts("near_dedup")
    assert sorted(deduped) == sorted((d, t) for d, t in identified if group[d] == d)
    clean = texts("decontamination")
    bad = {r[0] for r in brute.contamination(deduped, items) if r[5]}
    assert bad and sorted(clean) == sorted((d, t) for d, t in deduped if d not in bad)
    mixed = texts("source_mixing")
    copies = Counter(mixed)
    assert set(copies) <= set(clean) and max(copies.values()) <= 2
    size = {d: len(brute.SPACE.findall(t)) for d, t in clean}
    total = sum(size.values())
    assert 1.5 * total - 2 * max(size.values()) <= sum(size[d] * n for (d, _), n in copies.items()) <= 1.5 * total
    written = brute.rows_of(outs["token_output"], "start")
    assert written == brute.tokens(mixed, public_tokenizers.path("byte_bpe_50k.json"))


def test_run_is_the_stages(spark):
    assert P.run(spark, SF).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert P.ORACLE_SQL is None
    assert 4 <= len(P.STAGES) <= 5
