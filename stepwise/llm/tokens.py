"""Token-ID / binary output (operator 1).

Every document is encoded to token ids and the corpus is written as flat
unsigned-integer files in ascending ``doc_id`` order, ready to be memory
mapped by a training job. One shard per range partition holds three files:

* ``tokens-SSSSS.bin``: the ids of all its documents, back to back,
  little-endian ``uint16`` (``uint32`` if an id does not fit);
* ``offsets-SSSSS.bin``: ``n_docs + 1`` little-endian ``int64`` offsets of the
  documents inside the shard;
* ``docs-SSSSS.bin``: the documents' ids as ``int64`` (null ids sort first;
  how many there are is in the manifest).

The ``manifest`` table (Parquet, one row per shard) carries the shard's
document and token counts; a prefix sum over the shards in order gives each
shard's ``base``, so the corpus-wide position of a token is ``base + local
offset`` and no task ever sees more than its own shard.

Commit protocol: a task writes ``.<name>.<attempt>`` files and renames them
when they are complete. The rows of a shard are sorted on all the columns that
matter, so a retried or speculative attempt renames identical bytes over the
first ones; a lost executor costs its unfinished shards only.

Defined results: a null text is an empty text (it still gets the end id); rows
with equal ``doc_id`` are ordered by text hash, identical rows follow each other; an empty table
writes no shard and reads back as no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stepwise.llm.scratch import scratch_dir, shuffle_partitions, text_batches

#: The id appended to each document.
END_ID = 2
#: Bytes of pieces and ids that a worker remembers before it starts again with an
#: empty memory, with so many bytes more per piece; longer pieces aren't kept.
CACHE_BYTES, CACHE_ENTRY, CACHE_CHARS = 64 << 20, 160, 64
#: Bytes of text that are encoded together, and new pieces in one call's text.
GROUP_BYTES, JOINED = 1 << 20, 1 << 12
#: Marks that are cut off the end of a word, so that it is known with all of them.
TAIL = ".,;:!?#$%&*"
LETTERS = r"0-9A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}"
#: Token ids gathered before a read-back task hands on a batch.
READ_TOKENS = 1 << 20

MANIFEST = "shard int, n_docs long, n_null_ids long, n_tokens long, width int"
RECORD = "doc_id long, start long, n_tokens long, ids_crc32 long"

_loaded: dict[tuple[str, bool], "Encoder"] = {}


class Encoder:
    """``tokenizers`` encoding of whole texts, one distinct piece at a time.

    A byte-level pre-tokenizer with its default pattern, no prefix space and
    no normalizer attaches a single space to the word after it and lets a
    single line feed stand alone. Where no two white-space characters meet,
    the ids of a text are therefore the ids of its pieces (cut before every
    space and line feed) in a row; each distinct piece is encoded once.
    Other texts, and other kinds of tokenizers, are encoded whole. A word and the
    marks behind it are apart: no match goes on from a letter to a mark. What is
    new is handed to the library ``JOINED`` pieces to a text: a piece has its
    space or line feed at its start and nowhere else, so its first id, and no
    other one, starts with that byte.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = special_as_text
        self.by_piece = (
            spec.get("normalizer") is None
            and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space")
            and not any(" " in t["content"] or "\n" in t["content"] or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", []))
        )
        self.dtype = np.dtype("<u2") if self.tok.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        #: Ids that start with a space or a line feed.
        self.opens = np.zeros(self.tok.get_vocab_size(), bool)
        if self.by_piece and self.tok.truncation is None and self.tok.padding is None:
            opening = [i for t, i in self.tok.get_vocab(with_added_tokens=False).items() if t[:1] in ("\u0120", "\u010a")]
            self.opens[opening] = True
        #: Ids by piece: a word with the space before it (not written), a line
        #: feed with the word after it, or the first word with a space behind it.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0
        #: Whether a word and the marks behind it may be encoded one by one: no
        #: match of the pattern goes on from a letter or a digit to a mark.
        self.marks = not any(re.search(rf"\w[{re.escape(TAIL)}]", t["content"]) for t in spec.get("added_tokens", []))

    def _whole(self, texts: list[str]) -> list[bytes]:
        """``texts`` handed to the library as they are."""
        code = "H" if self.dtype.itemsize == 2 else "I"
        packed = [array(code, e.ids) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        if sys.byteorder == "big":
            for ids in packed:
                ids.byteswap()
        return [ids.tobytes() for ids in packed]

    def _apart(self, pieces: list[str]) -> list[bytes]:
        """The ids of each of ``pieces``, none of which tears white space apart."""
        out: list[bytes | None] = [None] * len(pieces)
        led = [i for i, p in enumerate(pieces) if p[0] in " \n"]
        parts = [led[at : at + JOINED] for at in range(0, len(led), JOINED)]
        for part in parts:  # one at a time: an encoding takes many times its ids
            text = "".join([pieces[i] for i in part])
            ids = np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
            ends = np.append(np.flatnonzero(self.opens[ids]), len(ids)) * self.dtype.itemsize
            if len(ends) == len(part) + 1 and ends[0] == 0:  # else not to be told apart
                packed, ends = ids.tobytes(), ends.tolist()
                for i, a, b in zip(part, ends, ends[1:]):
                    out[i] = packed[a:b]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, self._whole([pieces[i] for i in rest])):
            out[i] = ids
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, packed as ``self.dtype``."""
        ids, sizes = self.encode_flat(pa.array(texts, pa.large_string()))
        ends = np.cumsum(sizes).tolist()
        return [ids[a:b].tobytes() for a, b in zip([0, *ends], ends)]

    def encode_flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``texts`` in a row, and how many each text has.

        Arrow cuts the texts and numbers their distinct pieces, so a piece is
        looked up once per call; numpy puts the ids together by these numbers."""
        if not self.by_piece or not len(texts):
            return self._joined(self._whole(texts.to_pylist()))
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        first = cut.offsets.to_numpy()
        first, count = first[:-1], np.diff(first)
        coded = cut.values.dictionary_encode()
        at = np.array(coded.indices, copy=True)
        # A text's first piece is another one than the same word behind a space.
        at[first] = len(coded.dictionary) + np.arange(len(first))
        words, of, behind, marks = self._marks_off(coded.dictionary)
        alone: dict[str, int] = {}  # what stands at a text's start, or as if it did
        own = [alone.setdefault(p + " ", len(alone)) for p in [*_strings(cut.values.take(pa.array(first))), *marks]]
        got = self._pieces([*words, *alone])
        torn = np.fromiter((ids is None for ids in got), bool, len(got))
        # Each distinct piece is a word and the marks behind it, if there are any.
        k, n, none = len(words), len(first), len(got)
        got.append(b"")
        placed = np.array([*own, none - k]) + k
        pairs = np.column_stack([np.append(of, placed[:n]), np.append(placed[n:][behind], np.full(n, none))])
        if torn.any():  # texts with a piece that tears white space apart
            whole = np.logical_or.reduceat(torn[pairs[:, 0]][at], first)
            rows = np.flatnonzero(whole)
            # Their pieces give nothing, but for the first one.
            at[np.repeat(whole, count)] = len(pairs)
            at[first[rows]] = len(pairs) + 1 + np.arange(len(rows))
            own = none + np.arange(len(rows) + 1)
            pairs = np.vstack([pairs, np.column_stack([own, np.full(len(own), none)])])
            got = [ids or b"" for ids in got] + self._whole(texts.take(pa.array(rows)).to_pylist())
        known, sizes = _taken(*self._joined(got), pairs.ravel())
        ids, sizes = _taken(known, sizes.reshape(-1, 2).sum(axis=1), at)
        return ids, np.add.reduceat(sizes, first)

    def _joined(self, packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, packed), "i8", len(packed)) // self.dtype.itemsize
        return np.frombuffer(b"".join(packed), self.dtype), sizes

    def _marks_off(self, pieces: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, list[str]]:
        """Distinct words, the number of each piece's word and that of the marks
        behind it (-1: none, or more than 8), and distinct marks. Cut is behind
        letters and digits up to U+024F only, whose kind no version of Unicode
        changes."""
        behind = np.full(len(pieces), -1)
        if not self.marks:
            return _strings(pieces), np.arange(len(pieces)), behind, []
        bare = pc.utf8_rtrim(pieces, characters=TAIL)
        n = np.asarray(pc.subtract(pc.binary_length(pieces), pc.binary_length(bare)))
        cut = (n > 0) & (n <= 8) & np.asarray(pc.match_substring_regex(bare, f"[{LETTERS}]$"))
        coded = pc.if_else(pa.array(cut), bare, pieces).dictionary_encode()
        _, ends, data = pieces.buffers()
        ends, n = np.frombuffer(ends, "i8")[pieces.offset + 1 :][: len(pieces)][cut], n[cut]
        back = np.arange(8, 0, -1)
        last = np.frombuffer(data, "u1")[np.maximum(ends[:, None] - back, 0)] * (back <= n[:, None])
        kinds, behind[cut] = np.unique(last.astype("u1").view("<u8").ravel(), return_inverse=True)
        marks = [x.tobytes().lstrip(b"\0").decode() for x in kinds]
        return _strings(coded.dictionary), coded.indices.to_numpy(), behind, marks

    def _pieces(self, pieces: list[str]) -> list[bytes | None]:
        """The ids of each of ``pieces``, which are distinct; None for those that
        tear white space apart. Of the pieces known, those not asked for since the
        memory was half full the last time but one are forgotten."""
        got = list(map(self.known.get, pieces))
        lacking = [i for i, ids in enumerate(got) if ids is None]
        names = [pieces[i] for i in lacking]
        ids = list(map(self.older.get, names))
        new = [k for k, x in enumerate(ids) if x is None and not _tears(names[k])]
        some = [names[k] for k in new]
        for k, x in zip(new, self._apart([p[:-1] if p[-1] == " " else p if p[0] == "\n" else " " + p for p in some])):
            ids[k] = x
        for i, x in zip(lacking, ids):
            got[i] = x
        now = {p: x for p, x in zip(names, ids) if x is not None and len(p) <= CACHE_CHARS}
        self.known.update(now)
        self.held += 2 * sum(map(len, now)) + sum(map(len, now.values())) + CACHE_ENTRY * len(now)
        if self.held > CACHE_BYTES // 2:
            self.known, self.older, self.held = {}, self.known, 0
        return got


def _strings(pieces: pa.Array) -> list[str]:
    """``pieces``, none of which holds a space, as a list."""
    if not len(pieces):
        return []
    _, ends, data = pc.binary_join_element_wise(pieces, *(pa.scalar(x, pieces.type) for x in ("", " "))).buffers()
    return data[: np.frombuffer(ends, "i8")[len(pieces)]].to_pybytes().decode().split(" ")[:-1]


def _taken(ids: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of stretches of ``ids`` of the given sizes the ones numbered ``at``, in a
    row, and their sizes."""
    n = sizes[at]
    ends = np.cumsum(n)
    kind = "i4" if max(ends[-1], len(ids)) < 1 << 31 else "i8"
    place = np.repeat(((np.cumsum(sizes) - sizes)[at] - (ends - n)).astype(kind), n)
    place += np.arange(len(place), dtype=kind)
    return ids[place], n


def _tears(piece: str) -> bool:
    """Whether this way of cutting tears white space apart at this piece."""
    if piece[-1:] == " ":
        return len(piece) == 1  # nothing before the first space or line feed
    word = piece[piece[:1] == "\n" :]
    return not word or word[0].isspace()


def encoder(path: str, special_as_text: bool = False) -> Encoder:
    """One encoder per worker process."""
    key = (path, special_as_text)
    if key not in _loaded:
        _loaded[key] = Encoder(path, special_as_text)
    return _loaded[key]


def filesystem(uri: str):
    from pyarrow import fs

    if uri.startswith("s3a://"):
        uri = "s3://" + uri[6:]
    return fs.FileSystem.from_uri(uri)


def shared_root(spark: SparkSession, out_dir: str) -> str:
    """``out_dir`` as Spark's file system names it, with its scheme: a path
    without one is on the cluster's default file system, not on a worker's disk."""
    mark = f"{out_dir.rstrip('/')}/manifest-schema"
    spark.createDataFrame([], MANIFEST).coalesce(1).write.mode("overwrite").parquet(mark)
    return spark.read.parquet(mark).inputFiles()[0].rsplit("/", 2)[0]


def _groups(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in order, about GROUP_BYTES at a time (a longer one by itself)."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype="i8")
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + GROUP_BYTES, "right")))
        yield texts.slice(at, to - at)
        at = to


def _writer(out_dir: str, tokenizer_path: str, end_id: int, special_as_text: bool):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        shard, attempt = task.partitionId(), task.taskAttemptId()
        files, root = filesystem(out_dir)
        names = {k: f"{k}-{shard:05d}.bin" for k in ("tokens", "offsets", "docs")}
        enc = None
        streams: dict = {}
        n_docs = n_null = n_tokens = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if enc is None:
                enc = encoder(tokenizer_path, special_as_text)
                streams = {k: files.open_output_stream(f"{root}/.{v}.{attempt}") for k, v in names.items()}
                streams["offsets"].write(np.zeros(1, "<i8").tobytes())
            sizes = np.empty(batch.num_rows, "<i8")
            at = 0
            for group in _groups(batch.column("text").cast(pa.large_string())):
                ids, count = enc.encode_flat(group)
                sizes[at : at + len(group)] = count + 1
                streams["tokens"].write(np.insert(ids, np.cumsum(count), end_id).tobytes())
                at += len(group)
            streams["offsets"].write((n_tokens + np.cumsum(sizes)).astype("<i8").tobytes())
            streams["docs"].write(batch.column("doc_id").fill_null(0).to_numpy().astype("<i8").tobytes())
            n_docs += batch.num_rows
            n_null += batch.column("doc_id").null_count
            n_tokens += int(sizes.sum())
        if enc is not None:
            pa.default_memory_pool().release_unused()  # the worker stays
            for k, v in names.items():
                streams[k].close()
                files.move(f"{root}/.{v}.{attempt}", f"{root}/{v}")
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            sums = [shard, n_docs, n_null, n_tokens, enc.dtype.itemsize]
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(sums, types)], names=["shard", "n_docs", "n_null_ids", "n_tokens", "width"])

    return write


def write_token_files(
    docs: DataFrame,
    out_dir: str,
    tokenizer_path: str,
    *,
    end_id: int = END_ID,
    special_as_text: bool = False,
    shards: int | None = None,
) -> DataFrame:
    """Encode ``docs(doc_id, text)`` into flat files under ``out_dir`` (a
    folder that driver and executors share) and return the manifest with each
    shard's ``base``.

    One range shuffle on ``doc_id`` (with a text hash behind it, so that many
    rows of one id or of a null id still spread over shards); encoding happens
    after it, streaming, so a task holds one Arrow batch of texts.
    """
    spark = docs.sparkSession
    out_dir = shared_root(spark, out_dir)
    order = ["doc_id", "text_hash"]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).withColumn("text_hash", F.xxhash64("text"))
    written = (
        rows.repartitionByRange(shards or shuffle_partitions(spark), *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
        .mapInArrow(_writer(out_dir, tokenizer_path, end_id, special_as_text), MANIFEST)
    )
    with text_batches(spark):
        written.write.parquet(f"{out_dir}/manifest")
    return read_manifest(spark, out_dir)


def read_manifest(spark: SparkSession, out_dir: str) -> DataFrame:
    """The shards in order, with ``base``: the tokens of all shards before.
    The window sees one row per shard."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    rows = spark.read.schema(MANIFEST).parquet(f"{out_dir}/manifest")
    return rows.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


class _Shard:
    """The three files of a shard: memory mapped where the folder is a mounted
    one, else read by range."""

    def __init__(self, out_dir: str, shard: int, width: int):
        self.files, self.root = filesystem(out_dir)
        self.shard, self.width = shard, width

    def _array(self, kind: str, dtype: str) -> np.ndarray:
        path = f"{self.root}/{kind}-{self.shard:05d}.bin"
        if self.files.type_name == "local":
            return np.memmap(path, dtype=dtype, mode="r")
        with self.files.open_input_file(path) as f:
            return np.frombuffer(f.read(), dtype=dtype)

    def tokens(self) -> np.ndarray:
        return self._array("tokens", f"<u{self.width}")

    def offsets(self) -> np.ndarray:
        return self._array("offsets", "<i8")

    def docs(self) -> np.ndarray:
        return self._array("docs", "<i8")


def _reader(out_dir: str):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for m in batch.itertuples():
                shard = _Shard(out_dir, m.shard, m.width)
                tokens, offsets, docs = shard.tokens(), shard.offsets(), shard.docs()
                at, n = 0, len(docs)
                while at < n:
                    to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + READ_TOKENS, "right")) - 1)
                    to = min(to, n)
                    part = np.asarray(tokens[offsets[at] : offsets[to]]).astype("<u4")
                    cut = np.asarray(offsets[at : to + 1]) - offsets[at]
                    crcs = [zlib.crc32(part[a:b].tobytes()) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
                    ids = pd.Series(docs[at:to]).astype("Int64")
                    ids[np.arange(at, to) < m.n_null_ids] = pd.NA
                    yield pd.DataFrame({
                        "doc_id": ids,
                        "start": m.base + np.asarray(offsets[at:to]),
                        "n_tokens": np.diff(cut),
                        "ids_crc32": np.array(crcs, dtype="i8"),
                    })
                    at = to

    return read


def read_token_files(spark: SparkSession, out_dir: str) -> DataFrame:
    """Per document, from the files alone: its id, the corpus-wide start of
    its ids, how many they are, and their CRC-32 as little-endian 32-bit
    integers. One task per shard."""
    out_dir = shared_root(spark, out_dir)
    shards = read_manifest(spark, out_dir)
    return shards.repartition(shuffle_partitions(spark), "shard").mapInPandas(_reader(out_dir), RECORD)


def tokenize_documents(docs: DataFrame, tokenizer_path: str, out_dir: str | None = None, **options) -> DataFrame:
    """Write ``docs`` as token files and return what the files hold."""
    spark = docs.sparkSession
    out_dir = out_dir or scratch_dir(spark, "tokens")
    write_token_files(docs, out_dir, tokenizer_path, **options)
    return read_token_files(spark, out_dir)
