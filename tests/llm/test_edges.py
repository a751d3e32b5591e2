"""Nulls, empty and long texts, ties, repeated rows, empty tables and columns
of clashing names: the results that the docstrings define."""

from __future__ import annotations

import hashlib
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stepwise.llm import bpe, divergence, language, lines, mixing, periodic, pii, repeats, scratch, secrets, simhash, suffix, tokens, topk
from stepwise.llm import decontam
from tests.llm import brute

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size long, text_hash string, target string,"
    " label string, fp string, line string, key string, doc string, kind string, hits string, component_id string"
)
PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"
LONG = " ".join(f"w{i * 7919 % 100003}" for i in range(60_000))
TEXTS = [
    (1, PASSAGE + " and some more words that follow it in this text\n" + "x" * 150, "en", "a"),
    (2, PASSAGE + " and some more words that follow it in this text\n" + "x" * 150, "en", "a"),
    (2, "the second text of document two", None, "b"),
    (3, None, "en", None),
    (3, None, "en", None),
    (4, "", "fr", "a"),
    (None, "a text without an id " + PASSAGE, "de", "b"),
    (5, LONG, "en", "a"),
    (6, "same row twice, " + PASSAGE, "en", "b"),
    (6, "same row twice, " + PASSAGE, "en", "b"),
    (7, " \n\t ", "xx", ""),
    (8, "éè ñ ß 日本語 \U0001f600 " * 30, "fr", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 1, 1, *["extra"] * 10) for r in TEXTS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_by_order():
    """Null ids first, then ids; rows of an id are told apart by text only."""
    return sorted(((-1 if d is None else d), t or "") for d, t, _, _ in TEXTS)


def test_tokens(spark, docs, empty, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    got = tokens.tokenize_documents(docs, path, str(tmp_path / "t"), shards=3).orderBy("start").collect()
    tok = Tokenizer.from_file(path)
    want = sorted(
        (-1 if d is None else d, zlib.crc32(np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()))
        for d, t, _, _ in TEXTS
    )
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.ids_crc32) for r in got) == want
    assert [-1 if r.doc_id is None else r.doc_id for r in got] == [d for d, _ in want]
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    assert tokens.tokenize_documents(empty, path, str(tmp_path / "e")).count() == 0


def test_pieces_are_the_whole_text():
    import public_tokenizers

    enc = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ["a  b", " a b", "a \n b", "a\n\n\nb", "a\tb  c\r\n d ", " ", "\n", "a　 b", "it's 12,3", "x\t", "a\x1cb \x1c c", "é ü z !"]:
        assert np.frombuffer(enc.encode([text])[0], enc.dtype).tolist() == enc.tok.encode(text, add_special_tokens=False).ids
    # Together, with a memory that is emptied, and with pieces too long for it.
    texts = ["", "one two", "one  two", "x" * 500 + " two", "\nline", "日本語" * 100 + " a\nb", "one two", "<|endoftext|> one"] * 3
    for size in (1, 10**9):
        small = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
        tokens.CACHE_BYTES, before = size, tokens.CACHE_BYTES
        try:
            for _ in range(2):
                got = [np.frombuffer(x, enc.dtype).tolist() for x in small.encode(texts)]
                assert got == [enc.tok.encode(t, add_special_tokens=False).ids for t in texts]
        finally:
            tokens.CACHE_BYTES = before
        assert all(len(p) <= tokens.CACHE_CHARS for p in small.known)


def test_new_pieces_are_handed_over_together(monkeypatch):
    import public_tokenizers

    enc = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [f"First{i} wordé{i} 'll{i}\nline{i}\t {i}日本 <|endoftext|> \u0120{i} \u010a x{i}\t" for i in range(200)] + ["a  b", "\n", " "]
    handed = []
    monkeypatch.setattr(tokens.Encoder, "_whole", lambda self, some, own=tokens.Encoder._whole: handed.extend(some) or own(self, some))
    got = [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(texts)]
    assert got == [enc.tok.encode(t, add_special_tokens=False).ids for t in texts]
    # By themselves: the first words, and the texts whose white space would be torn apart.
    assert sorted(handed) == sorted([f"First{i}" for i in range(200)] + ["a"] + texts[-3:])


def test_words_are_encoded_without_the_marks_behind_them(monkeypatch):
    """A word is learnt once, whatever marks follow it, and what is asked for
    again outlives a full memory."""
    import public_tokenizers

    enc = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    asked = []
    monkeypatch.setattr(tokens.Encoder, "_apart", lambda self, some, own=tokens.Encoder._apart: asked.extend(some) or own(self, some))
    marks = [".", ",", "...", "?!", ";:", "***", "$$$", "%#&", "!" * 9, "\u2026"]
    words = ["Zorblax", "qué", "naïveté", "x1", "don't", "a'", "²", "×", "日本", "ŀ", "\n.", "<|endoftext|>", "(a)", "", "."]
    texts = [f"{w}{m} {w}{m}\n{w}{m} {m}{w}{m} {w}" for w in words for m in marks]
    assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(texts)] == [enc.tok.encode(t, add_special_tokens=False).ids for t in texts]
    # Alone: nine marks, and those beyond ASCII, stay with their word.
    assert sorted(p for p in asked if p.startswith(" Zorblax")) == [" Zorblax", " Zorblax" + "!" * 9, " Zorblax\u2026"]
    # Two halves: the word asked for each time isn't encoded again, others are.
    monkeypatch.setattr(tokens, "CACHE_BYTES", 2000)
    for i in range(50):
        enc.encode([f"a Zorblax. unseen{i}"])
    asked.clear()
    enc.encode(["a Zorblax, unseen0"])
    assert asked == [" unseen0", ","]
    flat, sizes = enc.encode_flat(pa.array([], pa.large_string()))
    assert len(flat) == len(sizes) == 0


def test_texts_travel_to_python_in_small_batches(spark, docs, monkeypatch, tmp_path):
    setting, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(setting)
    with scratch.text_batches(spark):
        sizes = spark.range(5000, numPartitions=1).mapInArrow(lambda bs: (b.slice(0, 1) for b in bs), "id long")
        assert sizes.count() == -(-5000 // scratch.TEXT_ROWS)
    assert spark.conf.get(setting) == before
    # The stages of the pipeline that hand whole texts to Python do so.
    for module in (simhash, language):
        keep = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, tag, keep=keep: (seen.append((tag, spark.conf.get(setting))), keep(df, tag))[1])
    simhash.simhash_groups(docs)
    language.keep_identified(docs)
    rows = {tag: n for tag, n in seen}
    assert rows["fingerprints"] == rows["text-evidence"] == str(scratch.TEXT_ROWS)
    assert rows["components"] == spark.conf.get(setting) == before
    # More rows than a batch, in order and whole.
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"))
    found = tokens.tokenize_documents(many, path, str(tmp_path / "many"), shards=1).orderBy("doc_id").collect()
    assert [r.doc_id for r in found] == list(range(3000))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(found, found[1:]))


def test_secrets(spark, docs, empty):
    got = secrets.find_secrets(docs).collect()
    assert len(got) == len(TEXTS) and all(r.secrets == [] for r in got)
    assert got[0].label == "extra"
    assert secrets.find_secrets(empty).count() == 0


@pytest.mark.parametrize(
    "text, found",
    [
        ('db_password = "hunter2xyz!9"', {("assign", "password = \"hunter2xyz"), ("literal", "hunter2xyz!9")}),
        ('a = "AKIA1"\nb = "IOSFODNN7ZQ3"\naccess_key = a + b', {("flow", "AKIA1"), ("flow", "IOSFODNN7ZQ3")}),
        ("PASS=abc123XYZ9\nDB_PASSWORD=${PASS}", {("literal", "abc123XYZ9"), ("flow", "abc123XYZ9")}),
        ('{"client_secret": "s3cr3tV4lu3!!"}', {("literal", "s3cr3tV4lu3!!"), ("assign", 'secret": "s3cr3tV4lu3')}),
        ("password: changeme", {("assign", "password: changeme")}),
        ("secret=token:abcdefgh", {("literal", "token:abcdefgh")}),
        ("the token: of the", set()),
        ("color = 'chartreuse9'", set()),
    ],
)
def test_lexer(text, found):
    assert {(k, text[a:b]) for k, a, b, _, _ in secrets.spans(text)} == found


def test_lexer_keeps_every_piece_of_a_constant():
    parts = "".join(f'k{i} = "p{i:03d}Zx9"\n' for i in range(100))
    texts = [
        parts + "whole = " + " + ".join(f"k{i}" for i in range(100)) + "\ndb_password = whole",
        'v = ""\n' + "".join(f'v = v + "p{i:03d}Zx9"\n' for i in range(100)) + "db_password = v",
    ]
    for text in texts:
        flow = [text[a:b] for k, a, b, _, _ in secrets.spans(text) if k == "flow"]
        assert flow == [f"p{i:03d}Zx9" for i in range(100)]
    doubled = 'v0 = "p1Zx9q7Kw2"\n' + "".join(f"v{i + 1} = v{i} + v{i}\n" for i in range(3000)) + "db_password = v3000"
    assert [doubled[a:b] for k, a, b, _, _ in secrets.spans(doubled) if k == "flow"] == ["p1Zx9q7Kw2"]


@pytest.mark.parametrize(
    "text, name",
    [
        ('password: str = "hV3kq9ZtR2mB"', "password"),
        ('password: Optional[str] = "hV3kq9ZtR2mB"', "password"),
        ('password: str | None = "hV3kq9ZtR2mB"', "password"),
        ('const dbPassword: string = "hV3kq9ZtR2mB"', "dbPassword"),
        ('let api_key: &str = "hV3kq9ZtR2mB";', "api_key"),
        ('static API_KEY: &\'static str = "hV3kq9ZtR2mB";', "API_KEY"),
        ('var password string = "hV3kq9ZtR2mB"', "password"),
        ('const string password = "hV3kq9ZtR2mB";', "password"),
        ('char password[] = "hV3kq9ZtR2mB";', "password"),
        ('private_key = (\n    "hV3kq9ZtR2mB"\n)', "private_key"),
        ('private_key =\n    "hV3kq9ZtR2mB"\n', "private_key"),
        ('{"client_secret":\n  "hV3kq9ZtR2mB"}', "client_secret"),
        ('password:\n"api_token": "hV3kq9ZtR2mB"', "api_token"),
    ],
)
def test_lexer_on_declarations(text, name):
    found = [(k, text[a:b], n) for k, a, b, n, _ in secrets.spans(text) if k not in secrets.BASE_KINDS]
    assert found == [("literal", "hV3kq9ZtR2mB", name)]


def test_lexer_on_values_that_look_like_types():
    text = "password: abc123XYZ9 = other"
    assert ("literal", "abc123XYZ9") in {(k, text[a:b]) for k, a, b, _, _ in secrets.spans(text)}
    text = 'part: str = "hV3kq9ZtR2mB"\nprivate_key: Final[str] = (part +\n  "x8Lw2PqN5sYd"\n  "Wc4Jd7RkT1vB")'
    found = {(k, text[a:b], n) for k, a, b, n, _ in secrets.spans(text)}
    assert found == {
        ("flow", "hV3kq9ZtR2mB", "private_key"), ("literal", "x8Lw2PqN5sYd", "private_key"), ("literal", "Wc4Jd7RkT1vB", "private_key")
    }


def test_repeats(spark, docs, empty):
    got = repeats.remove_repeats(docs, block_bytes=1 << 16, hot_runs=2).collect()
    assert len(got) == len(TEXTS)
    # Rows equal in id and text are one document; rows of an id are two.
    once = list(dict.fromkeys((d, t) for d, t, _, _ in TEXTS))
    order = {r: i for i, r in enumerate(sorted(once, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")))}
    want = {}
    for i, *rest in brute.repeats([(i, r[1]) for r, i in order.items()]):
        want.setdefault(next(r[0] for r, j in order.items() if j == i), set()).add(tuple(rest))
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) in want[r.doc_id]
    assert sum(r.n_removed for r in got) > 0
    assert repeats.remove_repeats(empty).count() == 0


def test_repeats_on_crafted_overlaps(spark):
    rng = np.random.default_rng(5)
    alphabet = np.frombuffer(b"ab cd", np.uint8)
    base = alphabet[rng.integers(0, 5, 4000)].tobytes().decode()
    texts = []
    for i in range(60):
        cuts = rng.integers(0, 3800, 3)
        texts.append((i, "".join(base[c : c + int(rng.integers(60, 200))] for c in cuts) + ("z" * int(rng.integers(0, 260)) if i % 7 == 0 else "")))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    want = [r[1:] for r in brute.repeats(texts)]
    for hot in (2, 10_000):
        got = repeats.remove_repeats(docs, block_bytes=1000, hot_runs=hot).orderBy("doc_id").collect()
        assert [(r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got] == want


def test_anchors_take_bounded_memory(monkeypatch):
    data = np.random.default_rng(3).integers(97, 101, 1 << 20).astype(np.uint8).tobytes()
    ends = np.array([5000, 5000, 5099, 300_000, len(data)])
    starts = np.concatenate(([0], ends[:-1]))
    tracemalloc.start()
    found = suffix.segments(data, starts, ends, 100)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 * len(data)  # it was 44 with all grams at once
    # Where the pieces end makes no difference.
    for piece in (1 << 20, 99_991):
        monkeypatch.setattr(suffix, "PIECE", piece)
        assert all((a == b).all() for a, b in zip(found, suffix.segments(data, starts, ends, 100), strict=True))


def test_mixing(spark, docs, empty):
    got = mixing.mix(docs).collect()
    assert len(got) == len(TEXTS)
    assert all(0 <= r.copies <= 2 for r in got)
    assert sum(r["size"] == 0 for r in got) == 4  # null, null, empty, blank
    total = sum(r["size"] for r in got)
    assert sum(r["size"] * r.copies for r in got) <= 1.5 * total
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in got)
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


@pytest.mark.parametrize("sizes", [{"a": 900, "b": 10, "c": 40}, {None: 5, "z": 5, "": 1}, {"a": 0, "b": 7}, {"a": 0}])
def test_targets(spark, sizes):
    rows = [(i, s, " ".join(["w"] * n)) for i, (s, n) in enumerate(sizes.items())]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    want = brute.targets(sizes)
    names = dict((i, s) for i, s, _ in rows)
    assert {names[r.doc_id]: pytest.approx(r.target) for r in got} == want


def test_language(spark, docs, empty):
    rows = docs.select("doc_id", F.col("lang").alias("declared"), F.col("source").alias("host"), "text")
    model = language.fit(docs.select("text", F.col("lang").alias("label")))
    got = language.identify(rows, model).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        if r.doc_id in (3, 4, 7):
            assert (r.language, r.posterior, r.accepted) == ("und", 0.0, False)
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns
    assert kept.where(F.col("doc_id").isin(3, 4, 7)).count() == 0
    assert language.keep_identified(empty).count() == 0


def _worded(syllables, n, seed, words=40):
    """Texts of made-up words of the given syllables."""
    rng = np.random.default_rng(seed)
    return [" ".join("".join(rng.choice(syllables, int(rng.integers(1, 4)))) for _ in range(words)) for _ in range(n)]


SYLLABLES = {
    "en": ["the", "ing", "wh", "tion", "ough", "ly"], "fr": ["eau", "que", "oi", "ment", "aux", "ç"],
    "de": ["sch", "ung", "ei", "ich", "pf", "ü"], "es": ["ado", "ción", "ll", "ñ", "os", "ez"], "it": ["zzo", "gli", "ghe", "ssi", "cch", "nno"],
}


def test_language_of_foreign_text(spark):
    """A label outside the wanted ones is told and filtered; text of no label is ``und``."""
    odd = {"en": ["en", "EN", " en-GB ", "en_US", "eng", "english", "zxx"], "it": ["it", "IT"]}
    rows = []
    for lang, syllables in SYLLABLES.items():
        for i, text in enumerate(_worded(syllables, 60, ord(lang[0]))):
            labels = odd.get(lang, [lang])
            rows.append((len(rows), text, labels[i % len(labels)], "h", lang))
    foreign = [*_worded(["ый", "ство", "ого", "ет"], 5, 1), *_worded(["szcz", "rzy", "ków", "żd"], 5, 2), "今天早上我们去市场买新鲜水果。" * 3, "kq zvx jqk wvq zzk xqj vkw " * 9]
    for text in foreign:
        rows.append((len(rows), text, None, "h", "und"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, truth string")
    model = language.fit(docs.select("text", F.col("lang").alias("label")))
    assert model[0] == sorted(SYLLABLES)
    got = language.identify(docs.select("doc_id", "text", "truth", F.lit(None).cast("string").alias("declared"), F.col("source").alias("host")), model).collect()
    assert [(r.doc_id, r.language) for r in got if r.language != r.truth] == []
    assert all(r.accepted == (r.truth in language.LANGUAGES) for r in got)
    kept = language.keep_identified(docs)
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows if r[4] in language.LANGUAGES}


def test_language_sample_is_of_distinct_texts(spark):
    """Copies of a text count once, so none fills the sample."""
    labels = [a + b for a in "abcde" for b in "abcdef"]
    rows = [(label, f"text {i} of {label}") for label in labels for i in [*range(50), *[50] * 50]]
    drawn = language._sample(spark.createDataFrame(rows, "label string, text string"), None, 25).collect()
    by_label = {label: [r.text for r in drawn if r.label == label] for label in labels}
    assert all(len(t) == len(set(t)) and 5 < len(t) < 45 for t in by_label.values())


def test_page_columns(spark):
    pages = spark.createDataFrame(
        [("https://u@blog.example.fr:80/x?y", '<!DOCTYPE html><HTML class="a" LANG=\'fr-CA\'><script>var a="<p>";</script><p>Bon&amp;jour</p>'), (None, None)],
        "url string, html string",
    )
    first, none = language.page_columns(pages).collect()
    assert (first.declared, first.host, first.text.split()) == ("fr", "blog.example.fr", ["Bon", "jour"])
    assert (none.declared, none.host, none.text) == ("", "", "")


def test_simhash(spark, docs, empty):
    got = simhash.simhash_groups(docs).collect()
    assert len(got) == len(TEXTS)
    assert {r.fp & (2**64 - 1) for r in got if r.doc_id in (3, 4, 7)} == {0}
    assert {r.component_id for r in got if r.doc_id in (1,)} == {1}
    prints = {brute.simhash(t) for _, t, _, _ in TEXTS}
    assert {r.fp & (2**64 - 1) for r in got} == prints
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({r.label for r in got})
    assert simhash.keep_one_per_group(empty).count() == 0


def test_simhash_links_are_all_found():
    """Every radius: the closure of the links is that of all close pairs."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 6, dtype=np.int64)
    prints = np.unique(np.concatenate([base ^ np.bitwise_xor.reduce(1 << rng.integers(0, 63, (n, 6)), axis=0) for n in range(9) for _ in range(8)]))
    for radius in (0, 1, 2, 3, 4):
        half, odd = divmod(radius, 2)
        assert _closure(prints, _meet(prints, radius)) == _closure(prints, [
            (int(a), int(b)) for i, a in enumerate(prints) for b in prints[:i] if (int(a) ^ int(b)).bit_count() <= radius
        ])


def test_simhash_links_inside_a_block_are_found():
    """``u`` and ``u ^ 7`` among smaller neighbours of ``u`` that hide it under every key."""
    u = (1 << 63) - (1 << 16)
    prints = {u, u ^ 7, u ^ 1 << 16}
    for a in range(16, 64, 2):
        x = u ^ 3 << a
        prints.add(x - (1 << 64) if x >> 63 else x)
    prints = np.array(sorted(prints), np.int64)
    assert len(set(_closure(prints, _meet(prints, 3)).values())) == 1


def _meet(prints, radius):
    """The variants of ``_variants``, built in Python."""
    from itertools import combinations

    half, odd = divmod(radius, 2)
    width = simhash.BITS // simhash.BLOCKS if odd else 0
    left = simhash.BITS - width
    keys, owners = [], []
    for fp in prints.view(np.uint64).tolist():
        for j in range(simhash.BLOCKS if odd else 1):
            cut = fp if not odd else (fp & ((1 << width * j) - 1)) | (fp >> width * (j + 1) << width * j) | j << left
            for n in range(half + 1):
                for c in combinations(range(left), n):
                    keys.append(cut ^ sum(1 << b for b in c))
                    owners.append(fp)
    order = np.argsort(np.array(keys, np.uint64), kind="stable")
    u, v = simhash._pairs(np.array(keys, np.uint64)[order].view(np.int64), np.array(owners, np.uint64)[order].view(np.int64), radius)
    return list(zip(u.tolist(), v.tolist()))


def _closure(nodes, links):
    root = {int(n): int(n) for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {n: find(n) for n in root}


def test_lines(spark, docs, empty):
    got = lines.dedup_lines(docs).collect()
    assert len(got) == len(TEXTS)
    by_id = {r.doc_id: r for r in got}
    assert by_id[3].text is None and by_id[3].n_lines == 0
    assert by_id[4].text == "" and by_id[7].text == " \n\t "
    assert sum(r.doc_id == 6 and r.n_removed == 0 for r in got) in (0, 2)
    assert lines.dedup_lines(empty).count() == 0


def test_lines_that_meet_no_other_are_not_joined(spark, monkeypatch):
    import random

    joined = []

    def similar(pairs, some, similarity, own=lines._similar):
        joined.append({r.id for r in some.select("id").collect()})
        return own(pairs, some, similarity)

    monkeypatch.setattr(lines, "_similar", similar)
    letters = random.Random(1)
    rows = [(i, "".join(letters.choices("abcdefghijklmnopqrstuvwxyzé", k=90))) for i in range(40)]
    rows += [(100, rows[0][1] + "x"), (101, "é" + rows[1][1])]
    links = lines._links(spark.createDataFrame(rows, "id long, line string"), 0.8, 32)
    assert {(r.u, r.v) for r in links.collect()} == {(0, 100), (1, 101)}
    assert joined == [{0, 1, 100, 101}]


def test_shingles_of_bytes_and_of_characters(spark):
    texts = ["abcdefghij", "abcdefgh", "abcdefg", "a", "abcdéfghij", "é" * 8, "日本語" * 4, "tab\tand\rmore", "🎉abcdefgh"]
    df = lines._with_shingles(spark.createDataFrame(list(enumerate(texts)), "id long, line string"), "line", "hashes")
    cut = {i: [t[k : k + 8] for k in range(len(t) - 7)] or [t] for i, t in enumerate(texts)}
    cut[8].insert(1, "?abcdefg")  # a character beyond the basic plane counts as two
    flat = spark.createDataFrame([(i, k, x) for i, xs in cut.items() for k, x in enumerate(xs)], "id long, k long, x string")
    want = {(r.id, r.k): r.h for r in flat.select("id", "k", F.xxhash64("x").alias("h")).collect()}
    assert {(r.id, k): h for r in df.collect() for k, h in enumerate(r.hashes)} == want
    assert df.columns == ["id", "line", "hashes"]


def test_bands_are_least_hashes_by_generated_code(spark):
    """The bands of every line, with no function called per element of an array
    and no second exchange; the bands' keys are counted apart from the bands."""
    import random

    letters = random.Random(2)
    texts = ["".join(letters.choices("abcdefgh日é ", k=k)) for k in (1, 7, 8, 9, 60, 700)] + ["🎉abcdefgh" * 3]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, line string")
    bands = lines._bands(rows)
    plan = bands._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and plan.count("Exchange") == 1
    cut = []
    for i, t in enumerate(texts):
        units = t.encode("utf-16-be")
        cut += [(i, bytearray(units[k : k + 16])) for k in range(0, max(len(units) - 14, 1), 2)]
    least = {}
    for r in spark.createDataFrame(cut, "id long, x binary").select("id", F.xxhash64("x").alias("h")).collect():
        at = ((r.h >> 40) + (1 << 23)) * lines.BANDS * lines.ROWS >> 24
        band = least.setdefault((r.id, at // lines.ROWS), [None] * lines.ROWS)
        band[at % lines.ROWS] = min(r.h, band[at % lines.ROWS] or r.h)
    names = [f"h{k}" for k in range(lines.ROWS)]
    flat = spark.createDataFrame([(i, b, *hs) for (i, b), hs in least.items()], "id long, band int, " + ", ".join(f"{n} long" for n in names))
    want = sorted((r.key, r.id) for r in flat.select(F.xxhash64("band", *names).alias("key"), "id").collect())
    assert sorted((r.key, r.id) for r in bands.collect()) == want


def test_lines_are_compared_by_units_or_by_characters(spark):
    """Pairs with and without characters beyond the basic plane: the same answer as by _with_shingles."""
    texts = ["abcdefghijkl" * 3 + "é", "abcdefghijkl" * 3 + "éx", "🎉abcdefghijklmnopqrstuvw", "🎈abcdefghijklmnopqrstuvw", "abcdefgh", "abcdefg"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, line string")
    pairs = rows.select(F.col("id").alias("u")).crossJoin(rows.select(F.col("id").alias("v"))).where("u < v")
    sets = {r.id: set(r.hashes) for r in lines._with_shingles(rows, "line", "hashes").collect()}
    got = {(r.u, r.v): r.near for r in lines._similar(pairs, rows, 0.8).collect()}
    assert got == {(u, v): len(sets[u] & sets[v]) >= 0.8 * len(sets[u] | sets[v]) for u in sets for v in sets if u < v}
    assert got[0, 1] and got[2, 3] and not got[0, 2]


def test_lines_in_a_crowd(spark):
    """A bucket larger than the pairwise bound: stars until no line is left."""
    base = "a line that very many documents hold with one small change in it number"
    texts = [(i, f"{base} {i}\nand line {i * i} of its own {i * 7919}") for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = brute.rows_of(lines.dedup_lines(docs, pairs_up_to=4), "doc_id")
    assert got == brute.dedup_lines(texts)


def test_lines_in_chains_in_a_crowd(spark, monkeypatch):
    """Links between two lines that are both linked to a centre, in a bucket
    of more lines than are compared pairwise: chains of lines that are similar
    to their neighbours only."""
    rng = np.random.default_rng(11)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    rows = []
    for chain in range(60):
        text = "".join(rng.choice(letters, 160))
        for step in range(4):  # each drops 10 characters in front and adds 10 at the end
            rows.append((len(rows), text[step * 10 : step * 10 + 130]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lines_of = docs.select(F.xxhash64("text").alias("id"), F.col("text").alias("line"))
    met = lines_of.select(F.lit(1).cast("long").alias("key"), "id")
    monkeypatch.setattr(lines, "_bands", lambda _: met)  # one bucket with all lines
    got = brute.rows_of(lines.dedup_lines(docs), "doc_id")
    assert got == brute.dedup_lines(rows)
    assert sum(r[2] for r in got) == 180


def test_lines_in_a_crowd_are_not_all_compared(spark, monkeypatch):
    """One bucket of many lines that are not similar, with pairs that are: few comparisons, and no link lost."""
    rng = np.random.default_rng(12)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    rows = []
    for _ in range(100):
        text = "".join(rng.choice(letters, 100))
        rows += [(len(rows), text), (len(rows) + 1, text + "yz")]
    met = spark.createDataFrame(rows, "id long, line string").select(F.lit(1).cast("long").alias("key"), "id")
    monkeypatch.setattr(lines, "_bands", lambda _: met)
    compared = []

    def similar(pairs, some, similarity, own=lines._similar):
        compared.append(pairs.count())
        return own(pairs, some, similarity)

    monkeypatch.setattr(lines, "_similar", similar)
    links = lines._links(spark.createDataFrame(rows, "id long, line string"), 0.8, 32).where("u != v")
    assert {tuple(sorted((r.u, r.v))) for r in links.collect()} == {(k, k + 1) for k in range(0, 200, 2)}
    assert sum(compared) < 400  # of 19900


def test_lines_buckets_are_not_one_task(spark, monkeypatch):
    """Bucket sizes by partial aggregation; first lines are cut per task before they meet."""
    plans, original = {}, lines.materialize

    def seen(df, tag):
        plans.setdefault(tag, df._jdf.queryExecution().sparkPlan().toString())
        return original(df, tag)

    monkeypatch.setattr(lines, "materialize", seen)
    rows = [(i, f"a line that many documents hold with a small change {i}") for i in range(6)]
    lines._links(spark.createDataFrame(rows, "id long, line string"), 0.8, 2)
    assert "Window" not in plans["buckets"]
    assert "WindowGroupLimit" in plans["heads"]


def test_unlike_lines_of_a_bucket_are_not_compared(spark, monkeypatch):
    """Short lines that meet by one shingle go by their marks; pairs that are of one group already aren't compared."""
    rng = np.random.default_rng(13)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    rows = [(i, "the same start " + "".join(rng.choice(letters, 50))) for i in range(24)]
    rows += [(i, "x" * 9 + "one line of many copies with a small change in it, number " + str(i)) for i in range(24, 32)]
    met = spark.createDataFrame(rows, "id long, line string").select(F.lit(1).cast("long").alias("key"), "id")
    monkeypatch.setattr(lines, "_bands", lambda _: met)
    compared = []

    def similar(pairs, some, similarity, own=lines._similar):
        compared.append(pairs.count())
        return own(pairs, some, similarity)

    monkeypatch.setattr(lines, "_similar", similar)
    links = lines._links(spark.createDataFrame(rows, "id long, line string"), 0.8, 32)
    groups = {r.node: r.component for r in lines.connected_components(links).collect()}
    assert groups == dict.fromkeys(range(24, 32), 24)
    assert sum(compared) < 80  # of 496


def test_marks_leave_no_similar_pair_out(spark):
    rng = np.random.default_rng(14)
    letters = np.array(list("abcdefgh é日"))
    texts = ["a", "abcdefgh", "abcdefghi", "x" * 500, "x" * 500 + "y", "🎉abcdefghijklmnopqrstuvw", "🎈abcdefghijklmnopqrstuvw"]
    for n in (30, 31, 90, 91, 300, 301, 2000):
        text = list("".join(rng.choice(letters, n)))
        for changes in range(5):
            some = text.copy()
            for at in rng.integers(0, n, changes):
                some[at] = "q"
            texts.append("".join(some))
    texts += ["".join("🎉🎈"[k >> i & 1] + x for i, x in enumerate("abcdefgh")) + "".join(rng.choice(letters, 60)) * 2 for k in range(8)]
    texts += ["🎉" + "".join(some) + x for x in ("", "🎈", "🎉", "🎈x")]
    rows = spark.createDataFrame(list(enumerate(dict.fromkeys(texts))), "id long, line string")
    marked = lines._marked(rows)
    pairs = rows.select(F.col("id").alias("u")).crossJoin(rows.select(F.col("id").alias("v"))).where("u < v")
    near = {(r.u, r.v): r.near for r in lines._similar(pairs, rows, 0.8).collect()}
    assert {(r.u, r.v): r.near for r in lines._similar(pairs, marked, 0.8).collect()} == near
    a, b = (marked.select(F.col("id").alias(i), F.col("mark").alias(m)) for i, m in (("u", "a"), ("v", "b")))
    held = a.crossJoin(b).where("u < v").select("u", "v", lines._hopeful("a", "b", 0.8).alias("may"))
    may = {(r.u, r.v): r.may for r in held.collect()}
    assert sum(near.values()) > 20 and all(may[p] for p, n in near.items() if n)
    assert sum(may.values()) < sum(near.values()) + len(may) / 5
    # The filter of crowds, in one bucket and in groups of their own.
    rim = rows.select(F.lit(1).alias("key"), "id")
    alone = spark.createDataFrame([], "node long, component long")
    with scratch.settings(spark, lines._IN_BUCKETS):
        asked = {(r.u, r.v) for r in lines._apart(rim, alone, marked, 0.8, crowd=True).collect()}
    assert asked == {p for p, n in near.items() if n}


@pytest.mark.parametrize("pairs_up_to", [0, 1, 32])
def test_lines_of_groups_are_linked_in_buckets_of_any_size(spark, monkeypatch, pairs_up_to):
    """By the prefix filter, by marks and 32 bits, and by marks alone: what all pairs give."""
    rng = np.random.default_rng(15)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    rows = []
    for _ in range(6):
        text = "".join(rng.choice(letters, 160))
        for step in range(5):  # similar to their neighbours only
            rows.append((len(rows), text[step * 10 : step * 10 + 110]))
    rows += [(len(rows) + i, "ab" * 60 + "c" * i) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lines_of = docs.select(F.xxhash64("text").alias("id"), F.col("text").alias("line"))
    met = lines_of.select(F.pmod("id", F.lit(2)).alias("key"), "id").union(lines_of.select(F.lit(7).cast("long"), "id"))
    monkeypatch.setattr(lines, "_bands", lambda _: met)
    got = brute.rows_of(lines.dedup_lines(docs, pairs_up_to=pairs_up_to), "doc_id")
    assert got == brute.dedup_lines(rows)


def test_shuffle_files_of_line_dedup_go_when_a_table_is_written(spark, docs, monkeypatch):
    name, seen = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []

    def written(df, tag, own=lines.materialize):
        seen.append(spark.conf.get(name))
        return own(df, tag)

    monkeypatch.setattr(lines, "materialize", written)
    before = spark.conf.get(name)
    lines.dedup_lines(docs)
    assert set(seen) == {"true"} and spark.conf.get(name) == before


def test_texts_are_shuffled_once_to_drop_their_lines(spark, docs):
    plan = lines.dedup_lines(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan[plan.index("Join"):]


def test_topk(spark, empty):
    rows = [
        (0, [1.0, 2.0]), (50, [0.5, -1.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [None, 1.0]),
        (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [1.0, 2.0, 3.0]), (7, [-1.0, 0.25]), (None, [9.0, 9.0]), (100, [1e17, 3.0]),
    ]
    vectors = spark.createDataFrame([(*r, "extra") for r in rows], "vec_id long, embedding array<double>, score string")
    got = topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), shard_rows=3).orderBy("query_id", "rank").collect()
    want = brute.top_k([r for r in rows if r[0] is not None])
    limit = 2**63 - 1
    assert [tuple(r) for r in got] == [(q, n, i, max(-limit - 1, min(limit, s))) for q, n, i, s in want]
    none = vectors.limit(0)
    assert topk.top_k(none, none).count() == 0
    assert topk.top_k(none, vectors).count() == 0
    assert topk.top_k(vectors, none).count() == 0


def test_topk_shards_rounds_and_copies(spark, monkeypatch):
    """Many shards, blocks and rounds give what all inner products give; a shard's
    tree is written once, and clustered vectors are not sent to every shard."""
    draw = np.random.default_rng(5)
    mids = draw.normal(size=(12, 6)) * 4
    rows = [(i, (mids[i % 12] + draw.normal(size=6) * 0.1).tolist()) for i in range(900)]
    rows += [(i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(900, 1300)]  # a third are one vector
    rows += [(1301, [0.5] * 6)] * 7 + [(1350, []), (1351, []), (1400, [2.0] * 3), (1401, [-2.0] * 3)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    kept = {}

    def seen(df, tag):
        kept[tag] = materialize(df, tag)
        return kept[tag]

    materialize = topk.materialize
    monkeypatch.setattr(topk, "materialize", seen)
    got = topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), shard_rows=40, block_queries=7, block_shards=5)
    assert sorted(map(tuple, got.collect())) == brute.top_k(rows)
    trees = kept["trees"]
    assert trees.count() == trees.select("shard").distinct().count() > 20
    sent = sum(kept[f"routes-{n}"].count() for n in range(len(topk.ROUNDS)))
    assert sent < 0.7 * trees.count() * kept["queries"].count()


def test_topk_bound_holds():
    draw = np.random.default_rng(6)
    rows = np.floor(256 * draw.normal(size=(500, 9)))
    tree = topk.BallTree(rows, leaf=16)
    queries = np.floor(256 * draw.normal(size=(20, 9)))
    bounds = topk._bounds(tree.centers, tree.radii, queries)
    for node, (lo, hi) in enumerate(tree.spans):
        assert ((tree.rows[lo:hi] @ queries.T).max(axis=0) <= bounds[node]).all()
    assert sorted(tree.order.tolist()) == list(range(500))


def test_pii(spark, docs, empty):
    got = pii.pseudonymized(docs, "k").collect()
    assert [(r.doc_id, r.text) for r in got] == [(d, t) for d, t, _, _ in TEXTS]
    assert pii.pseudonymize(docs, "k").columns == [*docs.columns, "pii"]
    assert pii.pseudonymized(empty, "k").count() == 0


def test_pii_formats(spark):
    def luhn(s):
        d = [int(c) for c in s if c.isdigit()][::-1]
        return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0

    one = "bob.smith7@mail3.example.com +1 (743) 555-3824 4111 1111 1111 1111 10.2.3.255 123-45-6789 1987-02-28 5.3.1990 GB82WEST12345698765432"
    other = "4111-1111-1111-1111 then 1987-02-28 and 1234567890123456 999.1.1.1 2023-02-30 000-12-3456"
    rows = spark.createDataFrame([(1, one), (2, other), (3, one)], "doc_id long, text string")
    a, b, c = (r.text for r in pii.pseudonymized(rows, "k").orderBy("doc_id").collect())
    assert a == c and a != one
    old, new = one.split(), a.split()
    assert all(x != y for x, y in zip(old, new) if x not in ("+1",))
    assert luhn("".join(new[4:8])) and new[4:8] == b.split()[0].split("-")
    assert b.split()[2] == new[10] and len(new[10]) == 10
    assert b.split()[4:] == other.split()[4:]
    iban = new[-1][4:] + new[-1][:4]
    assert int("".join(str(int(ch, 36)) for ch in iban)) % 97 == 1
    d = new[10].split("-")
    import datetime as dt

    dt.date(*map(int, d))


def test_pii_numbers_are_permuted(spark):
    n = 339 * 431
    rows = spark.range(0, n, 97).select(pii.permute_number(F.col("id"), pii.DAYS, F.lit("k"), "date").alias("x"), "id")
    got = [r.x for r in rows.collect()]
    assert len(set(got)) == len(got) and 0 <= min(got) and max(got) < n


def test_contamination(spark, docs, empty):
    items = spark.createDataFrame(
        [(1, PASSAGE, "x"), (1, "Some more words", "x"), (2, "second text", "x"), (3, None, "x"), (4, "", "x"), (None, "twice, alpha", "x"), (9, LONG, "x")],
        "item_id long, text string, hits string",
    )
    got = decontam.contamination(docs, items).collect()
    assert len(got) == len(TEXTS)
    plain = [(1, PASSAGE), (1, "Some more words"), (2, "second text"), (9, LONG), ("null", "twice, alpha")]
    for d, t, _, _ in TEXTS:
        (_, n, hit, found, _, bad), = brute.contamination([(0, t)], plain)
        assert any((r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, found, bad) for r in got if r.doc_id == d)
    kept = decontam.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r.contaminated for r in got)
    assert decontam.contamination(empty, items).count() == 0
    assert decontam.drop_contaminated(docs, items.limit(0)).count() == len(TEXTS)


def test_divergence(spark, docs, empty):
    rows = [(t, lang, s) for _, t, lang, s in TEXTS]
    got = sorted(map(tuple, divergence.divergence(docs, min_docs=1).collect()))
    assert got == brute.divergence(rows, min_docs=1)
    assert any(r[1] == "" for r in got)  # a null source
    # No kept term: distances of 0, no terms.
    got = divergence.divergence(docs, min_docs=100).collect()
    assert {r.part for r in got} == {"pair"} and not any(r.value for r in got)
    assert divergence.divergence(empty).count() == 0


def test_divergence_over_blocks_and_chunks(spark, monkeypatch):
    rows = [(" ".join(f"w{chr(97 + i * j % 26)}{chr(97 + j % 7)}" for j in range(40)), "en", f"s{i:02d}") for i in range(23)]
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", 4)
    monkeypatch.setattr(divergence, "CHUNK_TERMS", 3)
    monkeypatch.setattr(divergence, "HELD_BYTES", 1000)
    got = divergence.divergence(spark.createDataFrame(rows, "text string, lang string, source string"), min_docs=2)
    assert sorted(map(tuple, got.collect())) == brute.divergence(rows, min_docs=2)


def _bpe():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def test_bpe(spark, docs, empty):
    import tiktoken

    path, pattern = _bpe()
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.ranks(path), special_tokens={})
    got = bpe.decode_blocks(bpe.encode_blocks(docs, path, pattern), path).collect()
    order = lambda r: (-1 if r[0] is None else r[0], r[2])
    want = [(d, own.encode_ordinary(t or ""), (t or "").encode()) for d, t, _, _ in TEXTS]
    assert sorted(((r.doc_id, list(r.ids), bytes(r.decoded)) for r in got), key=order) == sorted(want, key=order)
    assert bpe.encode(empty, path, pattern).count() == 0


def test_bpe_words_are_cut_as_the_library_cuts(spark, monkeypatch):
    import tiktoken

    path, pattern = _bpe()
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.ranks(path), special_tokens={})
    texts = ["a  b", " a b", "a \n b", "a\n\n\nb", "a\tb  c\r\n d ", "\x1ca \x1c\x1d b", "a　 b", "it's we'LL 12,3", "x\u0085​ y", "<|endoftext|>", "日本語" * 2000, " " * 3000 + "x", "ab" * 5000]
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 50)
    monkeypatch.setattr(bpe, "SLICE", 7)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = bpe.encode_blocks(docs, path, pattern)
    assert got.count() > 5
    got = {r.doc_id: r for r in bpe.decode_blocks(got, path).collect()}
    for i, text in enumerate(texts):
        assert list(got[i].ids) == own.encode_ordinary(text) and bytes(got[i].decoded).decode() == text


def test_bpe_rows_of_ids_are_bounded(spark, monkeypatch):
    path, pattern = _bpe()
    monkeypatch.setattr(bpe, "DECODE_IDS", 20)
    texts = ["", None, *[f"one two {i}" for i in range(40)], "long " * 60, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = bpe.encode_blocks(docs, path, pattern)
    held = got.collect()
    assert {r.block for r in held} == {0} and len(held) > 5  # one block
    assert all(sum(r.n_ids) <= 20 or len(r.doc_ids) == 1 for r in held)
    decoded = {r.doc_id: bytes(r.decoded).decode() for r in bpe.decode_blocks(got, path).collect()}
    assert decoded == {i: text or "" for i, text in enumerate(texts)}


def test_bpe_decode(spark):
    path, _ = _bpe()
    rows = [(1, [5, 5, 6]), (2, None), (3, []), (None, [7])]
    by_id = {i: b for b, i in bpe.ranks(path).items()}
    got = {r.doc_id: bytes(r.decoded) for r in bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), path).collect()}
    assert got == {d: b"".join(by_id[i] for i in ids or []) for d, ids in rows}
    with pytest.raises(Exception, match="beyond the vocabulary"):
        bpe.decode(spark.createDataFrame([(1, [10**6])], "doc_id long, ids array<int>"), path).collect()


def test_periods(spark, docs, empty):
    got = periodic.periodic_runs(docs).collect()
    assert len(got) == len(TEXTS)
    assert all(r.runs == [] for r in got if r.doc_id != 5 and r.doc_id != 8)
    assert sorted(r.n_words for r in got) == sorted(len((t or "").encode().split()) for _, t, _, _ in TEXTS)
    by_words = {tuple((t or "").split(" ")): d for d, t, _, _ in TEXTS}
    assert by_words
    for r in got:
        if r.doc_id == 8:  # four words, thirty times
            assert [(x.start, x.length, x.period) for x in r.runs] == brute.periodic(TEXTS[-1][1].encode().split())
            assert bytes(r.kept).decode() == " ".join(TEXTS[-1][1].split()[: r.runs[0].period])
    assert periodic.periodic_runs(empty).count() == 0


def test_periods_of_texts_of_few_words():
    import random

    pick = random.Random(7)
    for _ in range(1500):
        size, kinds = pick.randrange(0, 80), pick.choice([1, 2, 2, 3, 5, 12])
        words = [str(pick.randrange(kinds)).encode() for _ in range(size)]
        for _ in range(pick.randrange(0, 4) if size > 3 else 0):
            at, q = pick.randrange(size), pick.randrange(1, max(2, size // 3))
            words[at:at] = (words[at : at + q] * 6)[: pick.randrange(1, 60)]
        assert [(s, e - s, q) for s, e, q in periodic.runs(words)] == brute.periodic(words)


@pytest.mark.parametrize("shape", ["one word", "blocks", "two words", "fibonacci", "squares"])
def test_periods_of_long_texts(shape):
    fib = [b"0"], [b"0", b"1"]
    while len(fib[1]) < 3000:
        fib = fib[1], fib[1] + fib[0]
    words = {
        "one word": [b"a"] * 4000,
        "blocks": ([b"a"] * 50 + [b"b"]) * 60,
        "two words": [b"x" if i * i % 7 & 1 else b"y" for i in range(3000)],
        "fibonacci": fib[1],
        "squares": [str(i * i % 101).encode() for i in range(3000)],
    }[shape]
    found = periodic.runs(words)
    assert [(s, e - s, q) for s, e, q in found] == brute.periodic(words)
    gone = set()
    for s, e, q in found:
        gone.update(range(s + q, e))
    assert periodic.collapse(words, found) == [w for i, w in enumerate(words) if i not in gone]


def test_re_pair_derives_its_text():
    words = [i * i % 11 for i in range(500)] + [1, 1, 1, 1, 1, 2, 1, 1]
    left, rules = periodic.re_pair(words, 11)

    def derived(symbol):
        return [symbol] if symbol < 11 else [x for part in rules[symbol - 11] for x in derived(part)]

    assert [x for s in left for x in derived(s)] == words
    pairs = list(zip(left, left[1:]))
    assert len(set(pairs)) >= len(pairs) - 1  # a a a is one pair twice, overlapping


def test_secrets_of_chained_constants_are_linear():
    import time

    texts = [
        'password = ""\n' + "".join(f'password = password + "p{i:04d}Zx9"\n' for i in range(4000)),
        'v = ""\n' + "".join(f'v = v + "p{i:04d}Zx9"\ndb_password_{i} = v\n' for i in range(4000)),
    ]
    for text in texts:
        start = time.perf_counter()
        found = secrets.spans(text)
        assert time.perf_counter() - start < 4  # the square of it would take minutes
        assert {text[a:b] for k, a, b, _, _ in found if k == "flow"} >= {f"p{i:04d}Zx9" for i in range(3999)}
    for text in ("*" * 200_000 + "a", "password = " + "your-" + "!" * 100_000 + " b", 'password = "' + "x" * 300_000, "a=" * 50_000, "k: " * 50_000):
        start = time.perf_counter()
        secrets.spans(text)
        assert time.perf_counter() - start < 4


@pytest.mark.parametrize(
    "text, literal",
    [
        ('key_secret = "/9j/4AAQSkZJRgABAQ4x"', "/9j/4AAQSkZJRgABAQ4x"),
        ('db_password = "postgres://bob:hV3kq9ZtR2mB@db/x"', "postgres://bob:hV3kq9ZtR2mB@db/x"),
        ('passphrase = "correct Horse battery 9 staple"', "correct Horse battery 9 staple"),
        ('api_key = "kTrue9xQz7Lm2"', "kTrue9xQz7Lm2"),
        ('auth_token = "abcTODOexample99"', "abcTODOexample99"),
        ('password = "/usr/local/lib/thing"', None),
        ('password = "https://example.org/reset"', None),
        ('password = "Please enter your 2 passwords."', None),
        ('password = "******"', None),
        ('token = "your-token-here"', None),
        ('token = "<insert token>"', None),
        ('secret = "{{ vault.secret }}"', None),
    ],
)
def test_secret_values(text, literal):
    found = {text[a:b] for k, a, b, _, _ in secrets.spans(text) if k == "literal"}
    assert found == ({literal} if literal else set())


def test_secret_flow_equals_plain_expansion():
    """Random programs of assignments: spans by walking every value whole."""
    import random

    pick = random.Random(11)
    for _ in range(300):
        names = ["a", "b", "c", "user", "db_password", "api_key", "auth"]
        text, known, want = "", {}, {}
        for _ in range(pick.randrange(1, 14)):
            name = pick.choice(names)
            parts, pieces, direct, text = [], {}, {}, text + f"{name} = "
            for j in range(pick.randrange(1, 4)):
                text += " + " if j else ""
                ref = pick.choice(names)
                if pick.random() < 0.5 and ref in known:
                    text += ref
                    parts.append(ref)
                else:
                    value = "".join(pick.choice("abXY12_") for _ in range(pick.randrange(2, 20)))
                    direct[len(text) + 1, len(text) + 1 + len(value), value] = None
                    text += f'"{value}"'
            text += "\n"
            for ref in parts:
                pieces |= known[ref]
            weight = secrets.name_score(name)
            every = [*direct, *(p for p in pieces if p not in direct)]
            if weight:
                for piece in every:
                    own = weight * secrets.value_score(piece[2])
                    if own >= secrets.MIN_SCORE:
                        key = ("literal" if piece in direct else "flow", *piece[:2])
                        want[key] = max(want.get(key, 0), round(own, 6))
            known[name] = dict.fromkeys(every)
        got = {s[:3]: s[4] for s in secrets.spans(text) if s[0] in ("literal", "flow")}
        # What a piece scores by itself is there; the strength of a whole may add to it.
        assert all(got.get(k, 0) >= v for k, v in want.items()), text


def _pseudonyms(spark, texts, key="k"):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in pii.pseudonymized(rows, key).orderBy("doc_id").collect()]


def test_pii_of_texts_of_any_shape(spark):
    """Long texts that look like addresses, numbers or groups: read without recursion."""
    n = 1_000_000
    shapes = [
        "x@" + "a." * (n // 2),
        "x@" + "a.b-" * (n // 4),
        "a" * n + "@b.com",
        "1" * n,
        "1.1." * (n // 4),
        "+1 " + "23 " * (n // 3),
        "DE89 " + "3704 " * (n // 5),
        "a:" * (n // 2) + "1",
        "1::" * (n // 3),
        "1/1/" * (n // 4),
        "@" * n,
    ]
    got = _pseudonyms(spark, [*shapes, "bob@mail.example"])
    assert got[-1] != "bob@mail.example" and got[-1].endswith(".example")
    assert [len(a) == len(b) for a, b in zip(got, shapes)].count(False) == 0


def test_pii_values_stay_linked_however_they_are_written(spark):
    linked = [
        ["Bob@Ex.com", "bob@ex.com", "BOB@EX.COM"],
        ["+1 415 555 0100", "+14155550100", "+1 (415) 555-0100", "(415) 555-0100", "415-555-0100"],
        ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000"],
        ["4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1111"],
        ["2001:db8::ff00:42:8329", "2001:0DB8:0:0:0:ff00:0042:8329"],
    ]
    for same in linked:
        got = _pseudonyms(spark, [f"see {x} there" for x in same])
        bare = {"".join(c for c in g[4:-6].lower() if c.isalnum())[-10 if "555" in same[0] else 0 :] for g in got}
        assert len(bare) == 1, got
        assert not any(x in g for x, g in zip(same, got))
        assert all(g.startswith("see ") and g.endswith(" there") for g in got)
    grouped, compact = _pseudonyms(spark, linked[2])
    assert grouped.replace(" ", "") == compact and [len(x) for x in grouped.split()] == [4, 4, 4, 4, 4, 2]


def test_pii_leaves_alone_what_is_none(spark):
    texts = ["at 12:30:45 sharp", "std::cout << a::b", "face::add", "::1", "10:20", "1:2:3:4:5:6:7:8:9", "DE89 3704 0044 0532 0130 01 EUR", "a@b", "1.2.3.4.5"]
    assert _pseudonyms(spark, texts) == texts


def test_pii_in_the_middle_of_words(spark):
    got = _pseudonyms(spark, ["IBAN DE89 3704 0044 0532 0130 00 EUR due", "fe80::1ff:fe23:4567:890a."])
    assert got[0].startswith("IBAN DE") and got[0].endswith(" EUR due") and "3704" not in got[0][:12]
    assert got[1].endswith(".") and got[1].count(":") == 7


def test_pii_leads_back_by_the_key_alone(spark):
    texts = [
        "bob.smith7@mail3.example.com or x_1@y.org, +1 (743) 555-3824 and +4930123456, 4111 1111 1111 1111",
        "10.2.3.255 2001:0db8:0000:0000:0000:ff00:0042:8329 123-45-6789 1987-02-28 05.03.1990 899-01-0001 665-99-9999 667-01-0001",
        "GB82WEST12345698765432 DE89 3704 0044 0532 0130 00 0.0.0.0 255.255.255.255 2199-12-31 1800-01-01",
        None,
        "",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    hidden = pii.pseudonymize(rows, "k")
    assert all(a.text != t for a, t in zip(hidden.orderBy("doc_id").collect(), texts) if t)
    assert [r.text for r in pii.reveal(hidden, "k").orderBy("doc_id").collect()] == texts
    assert [r.text for r in pii.reveal(hidden, "other").orderBy("doc_id").collect()][:3] != texts[:3]


def test_pii_key_and_column_names(spark):
    from stepwise.llm import queries

    assert pii.pii_key(spark) == pii.TEST_KEY
    spark.conf.set(pii.KEY_SETTING, "another")
    try:
        assert pii.pii_key(spark) == "another"
        with_key = {r.doc_id: r.text for r in queries.op9_pii_pseudonyms(spark, "/root/testdata/sf0.001").collect()}
    finally:
        spark.conf.unset(pii.KEY_SETTING)
    without = {r.doc_id: r.text for r in queries.op9_pii_pseudonyms(spark, "/root/testdata/sf0.001").collect()}
    assert with_key != without
    clash = spark.createDataFrame([(1, "a@b.cd", 5)], "doc_id long, text string, pii int")
    assert pii.pseudonymize(clash, "k").first().pii == ["email"]
    assert pii.reveal(pii.pseudonymize(clash, "k", kinds="found"), "k").first().pii == 5


def test_language_labels_are_read_once(spark):
    labelled = spark.createDataFrame([("some text", "en-GB"), ("ein Text", "DEU"), ("x", "und"), ("y", None)], "text string, label string")
    sample = language._sample(labelled, None, 10)
    assert sample._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract") == 1
    assert sorted(r.label for r in sample.collect()) == ["de", "en"]


def test_language_pages(spark):
    pages = [
        "<p>caf&eacute; &#233;t&eacute;</p>",
        "<!-- never closed " + "<!-- " * 200_000,
        "<script>" * 100_000 + "x",
        "a < b and <i>c</i>",
        None,
    ]
    rows = spark.createDataFrame([(i, "https://h.de/x", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    got = [r.text.strip() for r in language.page_columns(rows).orderBy("page_id").select("text").collect()]
    assert got[0] == "café été" and got[1] == "" and got[2] == "" and " ".join(got[3].split()) == "a < b and c" and got[4] == ""
