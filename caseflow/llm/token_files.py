"""Token-id files: frequency-ranked ids in byte-aligned variable-length code, control bytes apart.

An id is stored as its rank by corpus frequency (0 is the most frequent; equal counts by id) in one
to four bytes. Four ids share a control byte, two bits each, which hold the length less one; every
document starts a control byte. Control bytes and data bytes are separate streams, so a reader
finds all lengths in a 256-row table and gathers all values with array operations.

A folder holds ``ranks.bin`` (ids by rank, unsigned 32-bit) and ``part-NNNNN.tok`` files in ascending
order of doc_id. A file is its magic number and blocks of whole documents. All integers are little-endian:

    magic 8 bytes, then blocks:
    documents u64 | null doc_ids u64 | tokens u64 | control bytes u64 | data bytes u64
    doc_id i64 per document (the null ones first, as 0) | tokens u64 per document | control | data
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseflow.llm.common import map_arrow, materialise, qualified, ranges, store
from caseflow.llm.wordbpe import text_ids, word_bpe

MAGIC = b"VBTOKEN2"
BLOCK = "<5Q"
BLOCK_BYTES = struct.calcsize(BLOCK)
SMALLEST = -(1 << 63)
# Tokens a reader decodes at once, so that a file of any size is read in bounded memory.
DECODE_TOKENS = 1 << 20


# --- the code -----------------------------------------------------------------


@cache
def _lengths() -> np.ndarray:
    """256 x 4: the byte lengths of the four values of each control byte."""
    control = np.arange(256)[:, None]
    return (control >> (2 * np.arange(4)) & 3).astype(np.uint8) + 1


def encode(ranks: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Control and data bytes of consecutive documents with ``counts`` values each, and how many bytes
    of either each document has."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    widest = 1 + sum(bool(len(ranks)) and int(ranks.max()) > top for top in (0xFF, 0xFFFF, 0xFFFFFF))
    less = np.zeros(len(ranks), np.uint8)  # length less one
    for n in range(1, widest):
        less += ranks >= np.uint32(1 << (8 * n))
    control_sizes = -(-counts // 4)
    slot = np.arange(len(ranks)) + np.repeat(np.cumsum(control_sizes * 4 - counts) - (control_sizes * 4 - counts), counts)
    padded = np.zeros(int(control_sizes.sum()) * 4, np.uint8)
    padded[slot] = less
    four = padded.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    kept = np.arange(widest, dtype=np.uint8) <= less[:, None]
    data = ranks.view(np.uint8).reshape(-1, 4)[:, :widest][kept]
    ends = np.cumsum(counts)
    total = np.append(0, np.cumsum(less, dtype=np.int64))
    return control, data, control_sizes, counts + total[ends] - total[ends - counts]


def binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive runs of bytes as an Arrow column, without a Python object for each."""
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    )


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column, and the size of each value."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8), sizes


def byte_lengths(control: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Length of every value of consecutive documents; the padding of a last control byte is left out."""
    slots = -(-counts // 4) * 4
    lengths = _lengths()[control].ravel()
    if (slots == counts).all():
        return lengths
    begins = np.cumsum(slots) - slots
    used = np.ones(len(lengths), bool)
    for pad in (1, 2, 3):
        some = (slots - counts) >= pad
        used[(begins + slots)[some] - pad] = False
    return lengths[used]


def decode(control: np.ndarray, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Values of consecutive documents with ``counts`` values each."""
    lengths = byte_lengths(control, counts)
    ends = np.cumsum(lengths, dtype=np.int64)
    begins = ends - lengths
    values = data[begins].astype(np.uint32)
    for n in (1, 2, 3):
        longer = np.flatnonzero(lengths > n)
        if not len(longer):
            break
        values[longer] |= data[begins[longer] + n].astype(np.uint32) << np.uint32(8 * n)
    return values


# --- writing ------------------------------------------------------------------


def _size(path: str, end_id: int) -> int:
    return max(word_bpe(path).size, end_id + 1)


def _width(path: str, end_id: int) -> str:
    return "<u2" if _size(path, end_id) <= 1 << 16 else "<u4"


def tokenise(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """doc_id and the token ids of each whole text with ``end_id`` behind, as little-endian bytes.

    Ids take two bytes where the vocabulary fits, else four. A task ends with a row of its own that has
    no ids but how often it met each: 64-bit ``counts`` by id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _width(path, end_id)
        total = np.zeros(_size(path, end_id), np.int64)
        for batch in batches:
            texts = batch.column(1)
            for a, b in ranges(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), 4 << 20):
                ids, sizes = text_ids(path, texts.slice(a, b - a))
                ids = np.insert(ids.astype(kind), np.cumsum(sizes), end_id)
                total += np.bincount(ids, minlength=len(total))
                coded = binary(ids.view(np.uint8), (sizes + 1) * ids.itemsize)
                given = [batch.column(0).slice(a, b - a), coded, pa.nulls(b - a, pa.binary())]
                yield pa.RecordBatch.from_arrays(given, ["doc_id", "ids", "counts"])
        if total.any():
            own = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([total.astype("<i8").tobytes()])]
            yield pa.RecordBatch.from_arrays(own, ["doc_id", "ids", "counts"])

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_arrow(texts, run, "doc_id long, ids binary, counts binary")


def id_counts(tokens: DataFrame) -> DataFrame:
    """id and count over all rows, from the rows of counts; a task sends at most one row for each id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for counts in batch.column(0).to_pylist():
                got = np.frombuffer(counts, "<i8")
                total = total + got if len(total) else got
        (ids,) = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "count"])

    partial = map_arrow(tokens.select("counts").filter("counts is not null"), run, "id long, count long")
    return partial.groupBy("id").agg(F.sum("count").alias("count"))


def range_cuts(keys: DataFrame, parts: int) -> np.ndarray:
    """Ascending values that cut ``keys`` (one column, not null) into ``parts`` about even ranges; a key that
    fills several ranges is there several times. Quantiles are taken in double precision."""
    shares = [i / parts for i in range(1, parts)]
    if not shares:
        return np.zeros(0, np.int64)
    (cuts,) = keys.agg(F.percentile_approx(keys.columns[0], shares, max(10_000, 4 * parts))).first()
    return np.sort(np.array(cuts or [], np.int64))


def range_of(cuts: np.ndarray, keys: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """Ascending range numbers of ``keys``; equal keys are dealt to the ranges they fill by ``tie``, 32 bits."""
    low, high = np.searchsorted(cuts, keys, "left"), np.searchsorted(cuts, keys, "right")
    return low + (tie.astype(np.int64) * (high - low + 1) >> 32)


def _put(uri: str, pieces: Iterable[bytes]) -> None:
    """Write beside and rename, so that a reader never meets half a file and a repeated task
    puts the same bytes in place again."""
    files, path = store(uri)
    aside = f"{path}.{uuid.uuid4().hex}.writing"
    with files.open_output_stream(aside) as out:
        for piece in pieces:
            out.write(piece)
    files.move(aside, path)


def write_tokens(docs: DataFrame, folder: str, path: str, end_id: int) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into ``folder``; returns the manifest of its files.

    The corpus is tokenised and coded once. Rank counts go to the driver, one row for each id of the
    vocabulary at most, and the cuts of the key ranges. Only coded documents are shuffled, by ranges of
    doc_id; a doc_id that fills several ranges is dealt to them by a checksum of its ids. Equal doc_ids are
    ordered by that checksum, then by their bytes; a null doc_id is ordered with the smallest one. Files
    are written block by block, so no task holds a part. An empty table gives no file.
    """
    spark = docs.sparkSession
    folder = qualified(spark, folder)
    written = materialise(tokenise(docs, path, end_id), "tokens")
    kind = _width(path, end_id)
    counts = id_counts(written).orderBy(F.desc("count"), "id").collect()
    order = np.array([r["id"] for r in counts], np.uint32)
    files, where = store(folder)
    files.create_dir(where, recursive=True)
    _put(f"{folder}/ranks.bin", [order.astype("<u4").tobytes()])
    ranks = np.zeros(_size(path, end_id), np.uint32)  # a table of the vocabulary's size travels with the tasks
    ranks[order] = np.arange(len(order), dtype=np.uint32)
    tokens = written.filter("ids is not null").select("doc_id", "ids")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = written.filter("counts is null").select(F.coalesce("doc_id", F.lit(SMALLEST)).alias("key"))
    cuts = range_cuts(keys, parts)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes = bytes_of(batch.column(1))
            tie = np.array([zlib.crc32(b) for b in batch.column(1).to_pylist()], np.uint32)
            key = pc.fill_null(batch.column(0), SMALLEST).to_numpy()
            counts = sizes // np.dtype(kind).itemsize
            control, data, control_sizes, data_sizes = encode(ranks[ids.view(kind)], counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range_of(cuts, key, tie).astype(np.int32)),
                    batch.column(0),
                    pa.array(tie.astype(np.int64)),
                    pa.array(counts),
                    binary(control, control_sizes),
                    binary(data, data_sizes),
                ],
                ["part", "doc_id", "tie", "n", "control", "data"],
            )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2, np.int64)

        def blocks() -> Iterator[bytes]:
            yield MAGIC
            for batch in filled:
                given, counts = batch.column(0), batch.column(1).to_numpy().astype("<u8")
                control, data = (b"".join(batch.column(i).to_pylist()) for i in (2, 3))
                tokens = int(counts.sum())
                yield struct.pack(BLOCK, len(counts), given.null_count, tokens, len(control), len(data))
                yield pc.fill_null(given, 0).to_numpy().astype("<i8").tobytes()
                yield counts.tobytes()
                yield control
                yield data
                total[:] += len(counts), tokens

        filled = (b for b in batches if b.num_rows)
        first = next(filled, None)
        if first is None:
            return
        filled = chain([first], filled)
        name = f"part-{TaskContext.get().partitionId():05d}.tok"
        _put(f"{folder}/{name}", blocks())
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array(total[:1]), pa.array(total[1:])], ["file", "documents", "tokens"]
        )

    coded = map_arrow(tokens, code, "part int, doc_id long, tie long, n long, control binary, data binary")
    ordered = coded.repartitionById(parts, "part").sortWithinPartitions("doc_id", "tie", "control", "data")
    blocks = ordered.select("doc_id", "n", "control", "data")
    return materialise(map_arrow(blocks, write, "file string, documents long, tokens long"), "manifest")


# --- reading ------------------------------------------------------------------


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (tokens of all documents before it), n_tokens and ids_le (unsigned 32-bit
    little-endian ids) of every document in the files of ``folder``.

    The running total has one row for each file, and so has a task that reads. Files are decoded in blocks
    of whole documents.
    """
    folder = qualified(manifest.sparkSession, folder)
    before = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    files = manifest.select(
        "file",
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"),
        F.row_number().over(W.orderBy("file")).alias("task"),
    )
    n = max(1, manifest.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield from read_file(f"{folder}/{name}", f"{folder}/ranks.bin", start)

    spread = files.repartitionById(n, F.col("task") - 1).select("file", "start")
    return map_arrow(spread, run, "doc_id long, start long, n_tokens long, ids_le binary")


def read_file(uri: str, ranks_uri: str, start: int) -> Iterator[pa.RecordBatch]:
    files, path = store(ranks_uri)
    with files.open_input_stream(path) as file:
        ids_by_rank = np.frombuffer(file.read(), "<u4")
    files, path = store(uri)
    with files.open_input_stream(path) as file:
        if file.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{uri} is no token file")
        while head := file.read(BLOCK_BYTES):
            documents, nulls, _, control_bytes, data_bytes = struct.unpack(BLOCK, head)
            doc_id = np.frombuffer(file.read(8 * documents), "<i8")
            counts = np.frombuffer(file.read(8 * documents), "<u8").astype(np.int64)
            control = np.frombuffer(file.read(control_bytes), np.uint8)
            data = np.frombuffer(file.read(data_bytes), np.uint8)
            absent = np.arange(documents) < nulls
            # whole documents, about DECODE_TOKENS at a time
            block = (np.cumsum(counts) - counts) // DECODE_TOKENS
            edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), documents]
            for a, b in zip(edges, edges[1:]):
                n = counts[a:b]
                own, control = np.split(control, [int((-(-n // 4)).sum())])
                size = int(byte_lengths(own, n).sum(dtype=np.int64))
                ids = ids_by_rank[decode(own, data[:size], n)].astype("<u4")
                data = data[size:]
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_id[a:b], mask=absent[a:b]),
                        pa.array(start + ends - n),
                        pa.array(n),
                        binary(ids.view(np.uint8), 4 * n),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_le"],
                )
                start += int(n.sum())
