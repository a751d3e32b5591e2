"""Byte-level BPE encoding and decoding (operator 12).

Texts are cut into words by the pattern of the vocabulary, and each distinct
word of the whole corpus is encoded once:

* A task packs its documents into blocks of about ``BLOCK_BYTES`` of text (a
  longer document is a block of its own). A block holds its distinct words and,
  per word of its texts in order, the word's number in the block: the positions
  of the exploded words, packed. Words are written as a table and positions as
  files beside it, under names of the attempt that the table records, so a lost
  executor costs a task and numbers never change afterwards.
* The words of all blocks are exploded and shuffled by word: one row per block
  and word, not per occurrence. Sorted by word, each distinct one is encoded once
  by the merge ranks and its ids go back to all blocks that hold it; a task
  streams over its rows, however many hold one word.
* Per block the ids of its words meet its positions and are put together, in
  rows of up to ``DECODE_IDS`` ids (or one document), so that neither a worker
  nor the batch that goes to the next one holds a whole block of ids.
* Decoding joins the token-byte table (a row per vocabulary, so broadcast) and puts
  the bytes together by position, a row at a time.

Blocks of ids (``block, vocabulary, doc_ids, n_ids, ids``) are what both
directions share; ``encode`` and ``decode`` give and take one row per document.

Defined results: a null text is an empty one, which has no ids; repeated rows
each get their row; null ids of documents are kept; an id that the vocabulary
lacks decodes to nothing if ``decode`` is told to ``skip_unknown``, and is an
error otherwise; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepwise.llm.scratch import materialize, scratch_dir
from stepwise.llm.tokens import filesystem, shared_root

#: Characters of text in a block.
BLOCK_BYTES = 16 << 20
#: A task numbers its blocks from its own number times this; both fit 31 bits.
BLOCKS = 1 << 11
#: Words of blocks that an encoding task gathers before it hands them on.
GATHER = 1 << 17
#: Words or ids that are put together at a time, and ids of a row.
SLICE, DECODE_IDS = 1 << 16, 1 << 20

WORDS = "block long, doc_ids array<long>, n_words array<long>, words array<string>, positions string"
WORD_IDS = "block long, packed binary"
IDS = "block long, vocabulary string, doc_ids array<long>, n_ids array<long>, ids binary"
DECODED = "doc_id long, ids array<int>, decoded binary"

_loaded: dict = {}


def ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: base64 of the bytes, blank, rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f) if token}


def _word_encoder(path: str):
    """Encodes one word by the merge ranks: for this encoder every text is one
    word. One per worker process."""
    if path not in _loaded:
        import tiktoken

        _loaded[path] = tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=ranks(path), special_tokens={})
    return _loaded[path].encode_ordinary


def _narrow(values: np.ndarray, bound: int) -> np.ndarray:
    """As little-endian 16 bit if all values are below that, else 32 bit."""
    return values.astype("<u2" if bound <= 1 << 16 else "<u4")


def _squeezed(*parts: bytes) -> bytes:
    """Byte strings as one, compressed each."""
    packed = [zstandard.compress(p) for p in parts]
    return np.array([len(p) for p in packed], "<u4").tobytes() + b"".join(packed)


def _unsqueezed(packed: bytes, n: int) -> list[bytes]:
    sizes = np.frombuffer(packed, "<u4", n)
    ends = 4 * n + np.cumsum(sizes)
    return [zstandard.decompress(packed[e - s : e]) for s, e in zip(sizes.tolist(), ends.tolist())]


def _planes(values: np.ndarray) -> bytes:
    """Numbers of 32 bits by significance: all lowest bytes, then the next."""
    return values.astype("<u4").view("u1").reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, "u1").reshape(4, -1).T).view("<u4").ravel()


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> Iterator[np.ndarray]:
    """The stretches ``flat[starts[c]:][:sizes[c]]`` for the codes in order, a
    slice of codes at a time."""
    for at in range(0, len(codes), SLICE):
        part = codes[at : at + SLICE]
        size = sizes[part]
        ends = np.cumsum(size)
        yield flat[np.arange(ends[-1]) + np.repeat(starts[part] - ends + size, size)]


def _ends(sizes: np.ndarray, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The sizes of the first ``n`` codes together, for each ``n`` of ``at`` (ascending)."""
    out, total = np.zeros(len(at), np.int64), 0
    for begin in range(0, len(codes), SLICE):
        sums = total + np.cumsum(sizes[codes[begin : begin + SLICE]])
        inside = slice(np.searchsorted(at, begin, "right"), np.searchsorted(at, begin + len(sums), "right"))
        out[inside] = sums[at[inside] - begin - 1]
        total = int(sums[-1])
    return out


def _runs(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Stretches of documents of up to ``most`` ids (or one document) by the ids
    before each and after the last one."""
    at, n = 0, len(ends) - 1
    while at < n:
        to = min(n, max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1))
        yield at, to
        at = to


def _laid_out(strings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and sizes of an array of byte strings, as it holds them."""
    _, offsets, data = strings.buffers()
    ends = np.frombuffer(offsets, "=i8" if pa.types.is_large_binary(strings.type) else "=i4")
    ends = ends[strings.offset : strings.offset + len(strings) + 1]
    return np.frombuffer(data or b"", "u1"), ends[:-1], np.diff(ends)


def _joined(parts: Iterator[np.ndarray], dtype) -> np.ndarray:
    held = list(parts)
    return np.concatenate(held) if held else np.zeros(0, dtype)


def _pack(out_dir: str, pattern: str):
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task = TaskContext.get()
        cut, block = regex.compile(pattern), task.partitionId() * BLOCKS
        files, root = filesystem(out_dir)
        doc_ids: list = []
        n_words: list[int] = []
        number: dict[str, int] = {}
        codes: list[np.ndarray] = []
        size = 0

        def row() -> pd.DataFrame:
            if block >= (task.partitionId() + 1) * BLOCKS:
                raise ValueError("a task with too many blocks: read the table in smaller splits")
            name = f"positions-{block}-{task.taskAttemptId()}.bin"
            with files.open_output_stream(f"{root}/{name}", compression=None) as f:
                f.write(_squeezed(_planes(np.concatenate(codes))))
            return pd.DataFrame({"block": [block], "doc_ids": [doc_ids], "n_words": [n_words], "words": [list(number)], "positions": [name]})

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].astype(object).where(batch["doc_id"].notna(), None), batch["text"]):
                if doc_ids and size + len(text) > BLOCK_BYTES:
                    yield row()
                    doc_ids, n_words, number, codes, size, block = [], [], {}, [], 0, block + 1
                words = cut.findall(text)
                for word in words:
                    if word not in number:
                        number[word] = len(number)
                codes.append(np.fromiter(map(number.__getitem__, words), np.uint32, len(words)))
                doc_ids.append(doc_id)
                n_words.append(len(words))
                size += len(text)
        if doc_ids:
            yield row()

    return pack


def words_of(docs: DataFrame, pattern: str, out_dir: str) -> DataFrame:
    """``docs(doc_id, text)`` in blocks of words, positions in files below ``out_dir``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return materialize(texts.mapInPandas(_pack(out_dir, pattern), WORDS), "words")


def _encode(path: str, top: int):
    """Rows sorted by word: each distinct one encoded once, its ids by block."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _word_encoder(path)
        code = "H" if top <= 1 << 16 else "I"
        held: dict[int, tuple[array, array, list[bytes]]] = {}
        n, last, size, ids = 0, None, 0, b""

        def rows() -> pa.RecordBatch:
            packed = []
            for at, sizes, parts in held.values():
                numbers = np.array(at, np.uint32)
                order = np.argsort(numbers)  # by number: small differences
                steps = np.diff(numbers[order], prepend=np.uint32(0))
                ids_of = b"".join([parts[i] for i in order.tolist()])
                packed.append(_squeezed(_planes(steps), _planes(np.array(sizes, np.uint32)[order]), ids_of))
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(packed, pa.binary())], names=["block", "packed"])

        for batch in batches:
            for word, place in zip(*(batch.column(c).to_pylist() for c in ("word", "place"))):
                block, at = place >> 32, place & 0xFFFFFFFF
                if word != last:
                    packed = array(code, own(word))
                    last, size, ids = word, len(packed), packed.tobytes()
                if (mine := held.get(block)) is None:
                    mine = held[block] = (array("I"), array("I"), [])
                mine[0].append(at)
                mine[1].append(size)
                mine[2].append(ids)
            n += batch.num_rows
            if n >= GATHER:
                yield rows()
                held, n = {}, 0
        if held:
            yield rows()

    return encode


def _assemble(out_dir: str, path: str, top: int):
    """Blocks of ids from blocks of words and the ids of the block's words."""
    width = "=u2" if top <= 1 << 16 else "=u4"

    def assemble(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = filesystem(out_dir)
        for batch in batches:
            for r in batch.itertuples():
                held = [] if r.held is None else [_unsqueezed(h, 3) for h in r.held]
                flat = np.frombuffer(b"".join(h[2] for h in held), width)
                sizes_in = _joined((_from_planes(h[1]) for h in held), "<u4").astype(np.int64)
                at = _joined((np.cumsum(_from_planes(h[0]), dtype=np.uint32) for h in held), "<u4")
                starts, sizes = np.zeros((2, r.n), np.int64)
                starts[at], sizes[at] = np.cumsum(sizes_in) - sizes_in, sizes_in
                del held, at, sizes_in
                with files.open_input_file(f"{root}/{r.positions}") as f:
                    codes = _from_planes(*_unsqueezed(f.read(), 1))
                words_to = np.concatenate(([0], np.cumsum(r.n_words, dtype=np.int64)))
                ids_to = _ends(sizes, codes, words_to)
                for a, b in _runs(ids_to, DECODE_IDS):
                    ids = _joined(_gather(flat, starts, sizes, codes[words_to[a] : words_to[b]]), flat.dtype)
                    yield pd.DataFrame({
                        "block": [r.block],
                        "vocabulary": [path],
                        "doc_ids": [r.doc_ids[a:b]],
                        "n_ids": [np.diff(ids_to[a : b + 1])],
                        "ids": [_narrow(ids, top).tobytes()],
                    })
                del codes, starts, sizes, flat
        pa.default_memory_pool().release_unused()

    return assemble


def encode_blocks(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs(doc_id, text)`` in blocks of ids (a block in one or more rows)."""
    spark = docs.sparkSession
    out_dir, top = shared_root(spark, scratch_dir(spark, "positions")), _top(path)
    blocks = words_of(docs, pattern, out_dir)
    ids = (
        blocks.select("block", F.posexplode("words").alias("at", "word"))
        .select("word", F.shiftleft("block", 32).bitwiseOR(F.col("at").cast("long")).alias("place"))
        .repartition("word")
        .sortWithinPartitions("word")
        .mapInArrow(_encode(path, top), WORD_IDS)
        .groupBy("block")
        .agg(F.collect_list("packed").alias("held"))  # the words of one block
    )
    whole = blocks.select("block", "doc_ids", "n_words", "positions", F.size("words").alias("n")).join(ids, "block", "left")
    return whole.mapInPandas(_assemble(out_dir, path, top), IDS)


def _top(path: str) -> int:
    """Ids of a vocabulary are below this."""
    return max(ranks(path).values()) + 1


def token_bytes(spark: SparkSession, path: str) -> DataFrame:
    """``vocabulary, known, tokens``: the ids of a vocabulary and their bytes, in one row."""
    by_id = sorted((i, bytearray(b)) for b, i in ranks(path).items())
    row = (path, [i for i, _ in by_id], [b for _, b in by_id])
    return spark.createDataFrame([row], "vocabulary string, known array<int>, tokens array<binary>")


def _spell(top: int, skip_unknown: bool):
    """Documents from blocks of ids and the token-byte table."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {c: batch.column(c) for c in ("doc_ids", "n_ids", "ids", "known", "tokens")}
            for i in range(batch.num_rows):  # one row's share of the batch at a time, as it lies there
                flat, starts, sizes = _laid_out(column["tokens"][i].values)
                ids = np.frombuffer(column["ids"][i].as_buffer(), "<u2" if top <= 1 << 16 else "<u4")
                known = column["known"][i].values.to_numpy(zero_copy_only=False)
                there = np.zeros(top, bool)
                there[known] = True
                if not skip_unknown and not there[ids].all():
                    raise ValueError("ids that the vocabulary lacks")
                at, size = np.zeros(top, np.int64), np.zeros(top, np.int64)  # ids without bytes have none
                at[known], size[known] = starts, sizes
                text = _joined(_gather(flat, at, size, ids), np.uint8)
                n_ids = column["n_ids"][i].values.to_numpy(zero_copy_only=False)
                ends = np.concatenate(([0], np.cumsum(n_ids, dtype=np.int64)))
                bytes_to = _ends(size, ids, ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        column["doc_ids"][i].values,
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype("i4"))),
                        pa.Array.from_buffers(
                            pa.binary(), len(ends) - 1, [None, pa.py_buffer(bytes_to.astype("i4")), pa.py_buffer(text)]
                        ),
                    ],
                    names=["doc_id", "ids", "decoded"],
                )
            del batch, column
        pa.default_memory_pool().release_unused()

    return spell


def decode_blocks(blocks: DataFrame, path: str, *, skip_unknown: bool = False) -> DataFrame:
    """``doc_id, ids, decoded`` of blocks of ids."""
    # One row, of the size of the vocabulary file.
    table = F.broadcast(token_bytes(blocks.sparkSession, path))
    return blocks.join(table, "vocabulary").mapInArrow(_spell(_top(path), skip_unknown), DECODED)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` of ``docs(doc_id, text)``."""
    return decode_blocks(encode_blocks(docs, path, pattern), path).select("doc_id", "ids")


def _repack(path: str, top: int):
    def repack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            held, size = [], 0
            for doc_id, ids in zip(batch["doc_id"].astype(object).where(batch["doc_id"].notna(), None), batch["ids"]):
                ids = np.zeros(0, np.int64) if ids is None else np.asarray(ids, np.int64)
                if held and size + len(ids) > DECODE_IDS:
                    yield _block(block, held, path, top)
                    held, size, block = [], 0, block + 1
                held.append((doc_id, ids))
                size += len(ids)
            if held:
                yield _block(block, held, path, top)
                block += 1

    return repack


def _block(block: int, held: list, path: str, top: int) -> pd.DataFrame:
    ids = np.concatenate([i for _, i in held])
    if len(ids) and not 0 <= ids.min() <= ids.max() < top:
        raise ValueError("ids beyond the vocabulary")
    return pd.DataFrame({
        "block": [block],
        "vocabulary": [path],
        "doc_ids": [[d for d, _ in held]],
        "n_ids": [[len(i) for _, i in held]],
        "ids": [_narrow(ids, top).tobytes()],
    })


def decode(encoded: DataFrame, path: str, *, skip_unknown: bool = False) -> DataFrame:
    """``doc_id, ids, decoded`` of ``encoded(doc_id, ids)``."""
    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return decode_blocks(rows.mapInPandas(_repack(path, _top(path)), IDS), path, skip_unknown=skip_unknown)
