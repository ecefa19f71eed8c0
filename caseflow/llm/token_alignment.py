"""Alignment of two tokenizers over the same bytes, and how often their ids meet in the corpus.

Both tokenizers cut a text into tokens that end at byte offsets. The offsets are two ascending lists; the
shorter drives a galloping search, exponential and then binary, through the longer one. Offsets found in
both cut the tokens into groups, and the ranks that neighbouring keys find give the range of tokens each
token overlaps. An id pair's count needs the whole corpus: the links of a chunk of documents travel as
blocks to the bucket of their pair, which sums them, and back as one row for each document and bucket.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections.abc import Iterator
from functools import cached_property
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from caseflow.llm.blocks import SUMS, SUMS_ARROW, batches, chunk_numbers, document_sums, narrow, pack, runs, unpack
from caseflow.llm.common import chunks, map_arrow, materialise, text_bytes, worker_cache
from caseflow.llm.wordbpe import as_bytes, byte_symbols

# Keys of the shorter list that share one gallop; the binary search then stays inside its range.
GALLOP_KEYS = 512
CHUNK_BYTES = 2 << 20
# Words a worker keeps the ids of.
CACHED_WORDS = 150_000
_SPACED = re.compile(rb" *[^ ]+| +")


def gallop(keys: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each of the ascending ``keys`` the first place in the ascending ``ends`` that is not below it.

    A block of keys starts where the one before it ended, doubles its step until it has passed its last
    key, and searches each of its keys by halving inside that range.
    """
    found = np.empty(len(keys), np.int64)
    low = 0
    for begin in range(0, len(keys), GALLOP_KEYS):
        block = keys[begin : begin + GALLOP_KEYS]
        step = len(block)
        while low + step < len(ends) and ends[low + step] < block[-1]:
            step *= 2
        high = min(low + step + 1, len(ends))
        found[begin : begin + GALLOP_KEYS] = low + np.searchsorted(ends[low:high], block)
        low = int(found[min(begin + GALLOP_KEYS, len(keys)) - 1])
    return found


class Alignment(NamedTuple):
    """``a_ends`` and ``b_ends`` of a run of texts, one after the other: ``cut_a`` and ``cut_b`` mark the
    tokens that end a group; token ``a[i]`` and ``b[i]`` overlap, ascending."""

    cut_a: np.ndarray
    cut_b: np.ndarray
    a: np.ndarray
    b: np.ndarray


def align(a_ends: np.ndarray, b_ends: np.ndarray) -> Alignment:
    """Groups and overlaps of two lists of token ends over the same bytes, both ending at the last byte."""
    short, long = (a_ends, b_ends) if len(a_ends) <= len(b_ends) else (b_ends, a_ends)
    last = gallop(short, long)
    common = long[last] == short if len(long) else np.zeros(0, bool)
    first = np.zeros(len(short), np.int64)
    first[1:] = last[:-1] + common[:-1]
    counts = last - first + 1
    one = np.repeat(np.arange(len(short)), counts)
    other = np.arange(len(one)) - np.repeat(np.cumsum(counts) - counts - first, counts)
    in_long = np.zeros(len(long), bool)
    in_long[last[common]] = True
    if short is a_ends:
        return Alignment(common, in_long, one, other)
    return Alignment(in_long, common, other, one)


class Side(NamedTuple):
    """What the ids of a tokenizer stand for: their bytes, and their number with each separator behind it."""

    token_bytes: pa.Array
    lengths: np.ndarray
    size: int
    shown: pa.Array

    @classmethod
    def of(cls, token_bytes: list[bytes], separators: str) -> Side:
        shown = [f"{i}{s}".encode() for s in separators for i in range(len(token_bytes))]
        lengths = np.array([len(b) for b in token_bytes], np.int64)
        return cls(pa.array(token_bytes, pa.binary()), lengths, len(token_bytes), pa.array(shown, pa.binary()))


class Tokenizers:
    """Both tokenizers, each as its library loads it.

    The byte-level one runs on the rank file of the same vocabulary; a text that engine refuses goes to
    the library of the JSON file, whose ids are the same.
    """

    def __init__(self, byte_level: str, ranks: str, pieces: str) -> None:
        self._file = byte_level
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={}
        )
        byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        with open(byte_level, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            a[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        b = [
            bytes([int(name[3:5], 16)]) if self.pieces.is_byte(i) else name.replace("▁", " ").encode()
            for i, name in enumerate(names)
        ]
        self.a, self.b = Side.of(a, ",|"), Side.of(b, ",;")
        self.splits = not any("▁" in name.lstrip("▁") for name in names)
        self.known: dict[bytes, bytes] = {}

    @cached_property
    def exact(self) -> Tokenizer:
        """The library of the JSON file; its special strings count as plain text."""
        library = Tokenizer.from_file(self._file)
        library.encode_special_tokens = True
        return library

    def encode_a(self, text: str) -> list[int]:
        try:
            return self.fast.encode_ordinary(text)
        except BaseException as error:  # the engine's own failures are no Exception
            if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return self.exact.encode(text, add_special_tokens=False).ids

    def encode_b(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts that begin with a space, as little-endian unsigned 32-bit integers.

        The library adds one space of its own. No piece holds a space behind another character (checked
        when the vocabulary is read), so a text falls apart before its runs of spaces; words repeat, and the
        library sees those that are not in the bounded cache.
        """
        words = [_SPACED.findall(text) for text in texts] if self.splits else [[text] for text in texts]
        new = set().union(*words).difference(self.known)
        if len(self.known) + len(new) > CACHED_WORDS:
            self.known.clear()
            new = set().union(*words)
        given = list(new)
        found = self.pieces.encode([w[1:].decode("utf-8", "replace") for w in given], num_threads=1)
        self.known.update(zip(given, map(as_bytes, found), strict=True))
        self.known[b" "] = as_bytes([self.pieces.piece_to_id("▁")])  # one space at the end; the library adds none to ""
        return [b"".join(map(self.known.__getitem__, w)) for w in words]


def _flat(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, and how many each has."""
    counts = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
    return np.frombuffer(b"".join(ids), "<u4").astype(np.int64), counts


def _joined(parts: pa.Array, ids: np.ndarray) -> tuple[np.ndarray, memoryview]:
    """Where each of the parts begins, and the parts of ``ids`` one after the other."""
    taken = pc.take(parts, pa.array(ids)).cast(pa.large_binary())
    offsets = np.frombuffer(taken.buffers()[1], np.int64, len(ids) + 1, 8 * taken.offset)
    return offsets, memoryview(taken.buffers()[2] or b"")


class Chunk(NamedTuple):
    """Aligned documents: tokens in order, ``doc_a`` and ``doc_b`` the document of each, links by place."""

    a: np.ndarray
    b: np.ndarray
    doc_a: np.ndarray
    doc_b: np.ndarray
    links: Alignment
    kept: np.ndarray


def align_texts(tools: Tokenizers, texts: list[bytes]) -> Chunk:
    """Texts as UTF-8. One that is empty, or that the tokens of a side do not spell, has no tokens."""
    given = [i for i, t in enumerate(texts) if t]
    want = [b" " + texts[i] for i in given]
    a, n_a = _flat([as_bytes(tools.encode_a(text.decode("utf-8", "replace"))) for text in want])
    b, n_b = _flat(tools.encode_b(want))
    keep = np.ones(len(given), bool)
    for side, ids, counts in ((tools.a, a, n_a), (tools.b, b, n_b)):
        offsets, body = _joined(side.token_bytes, ids)
        bounds = offsets[np.concatenate([[0], np.cumsum(counts)])]
        for k, text in enumerate(want):
            keep[k] &= bytes(body[bounds[k] : bounds[k + 1]]) == text
    numbers = np.array(given, np.int64)
    tokens = []
    for side, ids, counts in ((tools.a, a, n_a), (tools.b, b, n_b)):
        wanted = np.repeat(keep, counts)
        ids = ids[wanted]
        tokens.append((ids, np.repeat(numbers[keep], counts[keep]), np.cumsum(side.lengths[ids])))
    (a, doc_a, a_ends), (b, doc_b, b_ends) = tokens
    return Chunk(a, b, doc_a, doc_b, align(a_ends, b_ends), numbers[keep])


def _group_digests(tools: Tokenizers, chunk: Chunk, n: int) -> list[str]:
    """Of every document the digest of its groups, ``a1,a2|b1;a3|b2``; empty without tokens."""
    links = chunk.links
    # a group's A tokens come before its B tokens, so every token moves behind those of earlier groups
    group_a = np.cumsum(links.cut_a) - links.cut_a
    group_b = np.cumsum(links.cut_b) - links.cut_b
    b_before = np.concatenate([[0], np.flatnonzero(links.cut_b) + 1])
    a_through = np.concatenate([np.flatnonzero(links.cut_a) + 1, [0]])
    order = np.empty(len(chunk.a) + len(chunk.b), np.int64)
    order[np.arange(len(chunk.a)) + b_before[group_a]] = chunk.a + tools.a.size * links.cut_a
    order[np.arange(len(chunk.b)) + a_through[group_b]] = 2 * tools.a.size + chunk.b + tools.b.size * links.cut_b
    shown = worker_cache("align", "shown", lambda: pa.concat_arrays([tools.a.shown, tools.b.shown]))
    offsets, body = _joined(shown, order)
    sizes = np.bincount(chunk.doc_a, minlength=n) + np.bincount(chunk.doc_b, minlength=n)
    bounds = offsets[np.concatenate([[0], np.cumsum(sizes)])]
    return [
        hashlib.sha256(body[begin : end - 1]).hexdigest() if end > begin else ""
        for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
    ]


_DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_MAPPED = f"bucket int, chunk long, at int, pairs binary, entries binary, {_DOCUMENT}"
_GATHERED = f"chunk long, at int, pairs binary, entries binary, best binary, {_DOCUMENT}"


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def _bucket_of(codes: np.ndarray, buckets: int) -> np.ndarray:
    mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def _link_blocks(chunk: Chunk, tools: Tokenizers, buckets: int) -> Iterator[tuple[int, bytes, bytes]]:
    """``(bucket, pairs, entries)``: the id pairs of a bucket in the chunk with their links, and for every
    document its pairs with theirs."""
    bits = (tools.a.size * tools.b.size).bit_length()
    docs = int(chunk.doc_a[-1]) + 1 if len(chunk.doc_a) else 1
    codes = chunk.a[chunk.links.a] * tools.b.size + chunk.b[chunk.links.b]
    key = ((_bucket_of(codes, buckets) * docs + chunk.doc_a[chunk.links.a]) << bits) | codes
    key.sort()
    begins = runs(key)
    links = np.diff(np.append(begins, len(key)))
    key = key[begins]
    bucket, doc = np.divmod(key >> bits, docs)
    own_code = (bucket << bits) | (key & ((1 << bits) - 1))
    pairs = np.unique(own_code)
    rank = np.searchsorted(pairs, own_code)
    totals = np.bincount(rank, weights=links, minlength=len(pairs)).astype(np.int64)
    ends = np.arange(buckets + 1)
    of_pairs, of_entries = np.searchsorted(pairs >> bits, ends), np.searchsorted(bucket, ends)
    pairs &= (1 << bits) - 1
    for number in np.flatnonzero(np.diff(of_pairs)).tolist():
        own = slice(of_pairs[number], of_pairs[number + 1])
        entry = slice(of_entries[number], of_entries[number + 1])
        first = runs(doc[entry])
        counts = np.diff(np.append(first, entry.stop - entry.start))
        yield (
            number,
            pack(pairs[own].astype(np.uint32), narrow(totals[own])),
            pack(narrow(doc[entry][first]), narrow(counts), narrow(rank[entry] - own.start), narrow(links[entry])),
        )


def _aligner(files: tuple[str, str, str], buckets: int):
    schema = _arrow(_MAPPED)

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = worker_cache("align", files, lambda: Tokenizers(*files))
        number = chunk_numbers()
        for batch in given:
            texts, ids = text_bytes(batch.column("text")), batch.column("doc_id").to_pylist()
            for begin, end in chunks(texts, CHUNK_BYTES):
                name, n = next(number), end - begin
                chunk = align_texts(tools, texts[begin:end])
                links = chunk.links
                figures = [
                    np.bincount(chunk.doc_a, minlength=n), np.bincount(chunk.doc_b, minlength=n),
                    np.bincount(chunk.doc_a[links.cut_a], minlength=n), np.bincount(chunk.doc_a[links.a], minlength=n),
                ]
                rows = [
                    {"bucket": (name + at) % buckets, "chunk": name, "at": at, "doc_id": doc_id}
                    | dict(zip(("n_a", "n_b", "n_groups", "n_links"), numbers, strict=True)) | {"groups_sha256": digest}
                    for at, (doc_id, digest, *numbers) in enumerate(
                        zip(ids[begin:end], _group_digests(tools, chunk, n), *(f.tolist() for f in figures), strict=True)
                    )
                ]
                rows += [
                    {"bucket": bucket, "chunk": name, "pairs": pairs, "entries": entries}
                    for bucket, pairs, entries in _link_blocks(chunk, tools, buckets)
                ]
                yield from batches(rows, schema)

    return run


def _gather(size_b: int):
    """Every bucket's blocks with the corpus-wide counts of their pairs, and its highest count for each B id."""
    schema = _arrow(_GATHERED)

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("gather", "align", dict)  # tokenizers and words of earlier tasks go
        held: list[dict] = []
        for batch in given:
            is_block = pc.is_valid(batch.column("pairs"))
            held += batch.filter(is_block).select(["chunk", "pairs", "entries"]).to_pylist()
            documents = batch.filter(pc.invert(is_block))
            if documents.num_rows:
                columns = {name: documents.column(name) for name in documents.schema.names if name != "bucket"}
                columns["best"] = pa.nulls(documents.num_rows, pa.binary())
                yield pa.RecordBatch.from_arrays([columns[name] for name in schema.names], schema=schema)
        if not held:
            return
        blocks = [unpack(row["pairs"]) for row in held]
        pairs, place = np.unique(np.concatenate([b[0] for b in blocks]), return_inverse=True)
        counts = np.zeros(len(pairs), np.int64)
        np.add.at(counts, place, np.concatenate([b[1].astype(np.int64) for b in blocks]))
        b_ids = (pairs % size_b).astype(np.int64)
        highest = np.zeros(size_b, np.int64)
        np.maximum.at(highest, b_ids, counts)
        seen = np.flatnonzero(highest)
        yield from batches([{"best": pack(seen.astype(np.uint32), highest[seen])}], schema)
        at = 0
        for row, block in zip(held, blocks, strict=True):
            own = place[at : at + len(block[0])]
            at += len(own)
            row["pairs"] = pack(b_ids[own].astype(np.uint32), counts[own])
            yield from batches([row], schema)

    return run


def _sums(highest):
    """For every document of a block the links at their B id's highest count, and the sum of the counts."""

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = highest.value
        for batch in given:
            for row in batch.to_pylist():
                b_ids, counts = unpack(row["pairs"])
                docs, sizes, rank, links = unpack(row["entries"])
                links = links.astype(np.int64)
                starts = (np.cumsum(sizes.astype(np.int64)) - sizes).astype(np.int64)
                n_best = np.add.reduceat(links * (counts == best[b_ids])[rank], starts)
                total = np.add.reduceat(links * counts[rank], starts)
                yield from batches([{"chunk": row["chunk"], "sums": pack(docs, n_best, total)}], SUMS_ARROW)

    return run


def align_documents(docs: DataFrame, byte_level: str, ranks: str, pieces: str, buckets: int) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256`` of its tokens by the byte-level tokenizer (A) and the piece tokenizer (B).

    A null or empty text, and one whose tokens do not spell it, has zeros and an empty digest, and takes no
    part in the counts. Rows keep apart whatever their doc_id (null, repeated); other columns are not read. An
    empty table gives an empty table. Pairs go to buckets by both ids and each document sends a pair once, so a
    frequent pair costs its bucket a number for each document that holds it. The highest count of each B id, one
    number for each id of the vocabulary, is all that the driver and the workers see of the corpus.
    """
    spark = docs.sparkSession
    size_b = sentencepiece.SentencePieceProcessor(model_file=pieces).get_piece_size()
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    mapped = map_arrow(given, _aligner((byte_level, ranks, pieces), buckets), _MAPPED)
    dealt = mapped.repartitionById(buckets, F.col("bucket"))
    held = materialise(map_arrow(dealt, _gather(size_b), _GATHERED), "aligned")

    best = np.zeros(size_b, np.int64)
    highest = held.filter("best is not null").select("best")
    merged = map_arrow(highest.coalesce(max(1, min(16, buckets))), _merge_best(size_b), "best binary")
    for row in merged.toLocalIterator():
        ids, counts = unpack(bytes(row["best"]))
        best[ids] = np.maximum(best[ids], counts)
    blocks = held.filter("pairs is not null").select("chunk", "pairs", "entries")
    sums = map_arrow(blocks, _sums(spark.sparkContext.broadcast(best)), SUMS)
    names = [part.split()[0] for part in _DOCUMENT.split(", ")]
    documents = held.filter("pairs is null and best is null").select("chunk", "at", *names)
    summed = document_sums(sums, {"n_best": "long", "count_sum": "long"})
    of_links = [F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in ("n_best", "count_sum")]
    return documents.join(summed, ["chunk", "at"], "left").select(*names[:-1], *of_links, names[-1])


def _merge_best(size_b: int):
    schema = pa.schema([("best", pa.binary())])

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros(size_b, np.int64)
        for batch in given:
            for value in batch.column("best").to_pylist():
                ids, counts = unpack(value)
                best[ids] = np.maximum(best[ids], counts)
        seen = np.flatnonzero(best)
        yield from batches([{"best": pack(seen.astype(np.uint32), best[seen])}], schema)

    return run
