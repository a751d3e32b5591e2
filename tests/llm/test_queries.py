"""The registered queries against plain versions on whole small tables."""

from __future__ import annotations

import re

import pytest

from stepwise.llm import queries as Q
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def test_op1_tokens(spark, docs):
    import public_tokenizers

    got = brute.rows_of(Q.op1_token_output(spark, SF), "doc_id")
    assert got == brute.tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


def test_op3_repeats(spark, docs):
    got = brute.rows_of(Q.op3_repeated_passages(spark, SF), "doc_id")
    want = brute.repeats(docs)
    assert got == want
    assert sum(r[2] for r in want) > 0


def test_op6_simhash(spark, docs):
    got = brute.rows_of(Q.op6_simhash_groups(spark, SF), "doc_id")
    prints = [(d, brute.simhash(t)) for d, t in sorted(docs)]
    group = brute.components(prints)
    assert got == [(d, f"{p:016x}", group[d]) for d, p in prints]


def test_op8_topk(spark):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert brute.rows_of(Q.op8_topk_search(spark, SF), "query_id", "rank") == brute.top_k(vectors)


def test_op10_contamination(spark, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = brute.rows_of(Q.op10_decontamination(spark, SF), "doc_id")
    want = brute.contamination(docs, items)
    assert got == want
    assert any(r[5] for r in want)


def test_op4_mixing(spark, docs):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    size = {r.doc_id: len(brute.SPACE.findall(r.text or "")) for r in rows}
    source = {r.doc_id: r.source for r in rows}
    sizes: dict = {}
    for d, n in size.items():
        sizes[source[d]] = sizes.get(source[d], 0) + n
    target = brute.targets(sizes)
    got = Q.op4_source_mixing(spark, SF).collect()
    assert len(got) == len(rows)
    taken: dict = {}
    for r in got:
        assert (r["size"], r.source_size) == (size[r.doc_id], sizes[source[r.doc_id]])
        assert r.target == pytest.approx(target[source[r.doc_id]])
        assert r.taken in (0, r["size"], 2 * r["size"])
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())
    largest = max(size.values())
    for s, n in taken.items():
        assert abs(n - target[s]) <= 2 * largest
    again = Q.op4_source_mixing(spark, SF).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_op2_base_spans(spark, docs):
    import hashlib

    assign = re.compile(r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    got = {r.doc_id: r for r in Q.op2_secret_scan(spark, SF).collect()}
    for doc_id, text in docs:
        spans = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        base = ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))
        r = got[doc_id]
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[1] == k for s in spans) for k in range(3))


def test_op5_languages(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = Q.op5_language_id(spark, SF).collect()
    docs = {r.doc_id: r for r in got if r.doc_id is not None}
    assert len(docs) == len(rows) and len(got) > len(rows)
    right = sum(docs[r.doc_id].language == r.lang for r in rows)
    assert right >= 0.95 * len(rows)
    assert sum(docs[r.doc_id].accepted for r in rows) >= 0.98 * len(rows)


def test_op9_pii(spark, docs):
    got = {r.doc_id: r for r in Q.op9_pii_pseudonyms(spark, SF).collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        for private in re.findall(r"[\w.+-]+@[\w.-]+\.\w+|\+1 \(\d{3}\) \d{3}-\d{4}", text):
            assert private not in got[doc_id].text
        if not re.search(r"[0-9@]", text):
            assert got[doc_id].text == text
        assert len(got[doc_id].text) == len(text) or got[doc_id].n_ip


def test_op7_lines(spark, docs):
    got = brute.rows_of(Q.op7_line_dedup(spark, SF), "doc_id")
    want = brute.dedup_lines(docs)
    assert sum(r[2] for r in want) > 0
    assert got == want


def test_op11_divergence(spark):
    rows = [(r.text, r.lang, r.source) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    got = sorted(map(tuple, Q.op11_source_divergence(spark, "/root/testdata/sf0.01").collect()))
    want = brute.divergence(rows)
    assert got == want
    assert {r[2] for r in want} == {"pair", "term"} and any(r[4] for r in want if r[2] == "pair")


def test_op12_bpe(spark, docs):
    import hashlib

    import public_tokenizers
    import tiktoken

    from stepwise.llm.bpe import ranks

    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    got = brute.rows_of(Q.op12_byte_bpe(spark, SF), "doc_id")
    want = []
    for doc_id, text in sorted(docs):
        ids = own.encode_ordinary(text or "")
        listed = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want.append((doc_id, len(ids), listed, hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == want


def test_op13_periods(spark, docs):
    got = brute.rows_of(Q.op13_periodic_runs(spark, SF), "doc_id")
    want = brute.periodic_runs(docs)
    assert got == want
    assert sum(r[1] for r in want) > 20


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_statements(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = Q.queries()[name](spark, SF)
    want = con.execute(Q.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())
