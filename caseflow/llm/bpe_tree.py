"""BPE encoding by tree concatenation, and decoding.

Text that the pre-tokeniser does not split can be very long. A piece of it is cut into leaves, all
leaves are encoded side by side, and neighbours are joined pairwise up a tree. Around each join a
window of tokens of both sides is encoded again; while its first token differs from the left side's
token there, or its last from the right side's, the window doubles. Two tokens may stand side by side
in an encoding exactly if encoding their joint text gives them back, and every pair in the joined
sequence lies in the left side, the window or the right side. So where both ends agree, the joined
sequence is the encoding of the whole, and it is exact.

A piece is what the pre-tokeniser leaves unsplit, whatever its length. Leaves are as short
as words, so longer words are joined from leaves too; words that come again are kept (``TreeWords``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.llm.common import map_arrow, ranges, return_free_memory, worker_cache
from caseflow.llm.wordbpe import WordBpe, WordIds, as_bytes, to_symbols, word_bpe

# Symbols of a leaf; tokens of each side in the first window. A piece has
# at most MAX_LEAVES leaves, which grow with it.
LEAF = 10
WINDOW = 2
MAX_LEAVES = 1 << 15
# Symbols of a run whose ids are kept, and how many of these.
KEPT_RUN = 12
KEPT_RUNS = 30_000
# Bytes of text whose words are coded together.
CHUNK_BYTES = 1 << 20


class Piece(NamedTuple):
    """Tokens of a run of symbols; ``at_end`` if it ends its piece."""

    symbols: str
    at_end: bool
    ids: tuple[int, ...]


class TreeEncoder:
    def __init__(self, bpe: WordBpe, leaf: int = LEAF, window: int = WINDOW) -> None:
        self.bpe, self.leaf, self.window = bpe, leaf, window
        self.joins = 0
        self.widths = bpe.widths.tolist()
        self.runs: tuple[dict[str, tuple[int, ...]], ...] = ({}, {})  # short runs inside and at the end of a piece

    def _encode(self, runs: list[tuple[str, bool]]) -> list[tuple[int, ...]]:
        """Every run as one unsplit piece; short runs recur in many pieces and are kept."""
        long: dict[tuple[str, bool], tuple[int, ...]] = {}
        for at_end in (False, True):
            kept = self.runs[at_end]
            if len(kept) > KEPT_RUNS:
                kept.clear()
            new = list({symbols for symbols, end in runs if end == at_end and symbols not in kept})
            if not new:
                continue
            ids, ends = (found.tolist() for found in self.bpe.pieces(new, at_end))
            for symbols, begin, end in zip(new, [0, *ends], ends):
                if len(symbols) <= KEPT_RUN:
                    kept[symbols] = tuple(ids[begin:end])
                else:
                    long[symbols, at_end] = tuple(ids[begin:end])
        return [long[run] if len(run[0]) > KEPT_RUN else self.runs[run[1]][run[0]] for run in runs]

    def encode(self, pieces: list[str]) -> list[tuple[int, ...]]:
        """Token ids of unsplit pieces of symbols; the joins of one level of all trees go together."""
        runs, sizes = [], []
        for symbols in pieces:
            leaf = max(self.leaf, -(-len(symbols) // MAX_LEAVES))
            ends = range(leaf, len(symbols), leaf)
            runs += [(symbols[end - leaf : end], False) for end in ends]
            runs.append((symbols[len(ends) * leaf :], True))
            sizes.append(len(ends) + 1)
        leaves = iter([Piece(*run, ids) for run, ids in zip(runs, self._encode(runs), strict=True)])
        trees = [list(islice(leaves, n)) for n in sizes]
        growing = [tree for tree in trees if len(tree) > 1]
        while growing:
            joined = iter(self._join([(t[i], t[i + 1]) for t in growing for i in range(0, len(t) - 1, 2)]))
            for tree in growing:
                odd = tree[-1:] if len(tree) % 2 else []
                tree[:] = [*islice(joined, len(tree) // 2), *odd]
            growing = [tree for tree in growing if len(tree) > 1]
        return [tree[0].ids for tree in trees]

    def _join(self, pairs: list[tuple[Piece, Piece]]) -> list[Piece]:
        out: list[Piece | None] = [None] * len(pairs)
        open_joins = list(range(len(pairs)))
        self.joins += len(pairs)
        width, widths = self.window, self.widths.__getitem__
        while open_joins:
            runs = []
            for i in open_joins:
                left, right = pairs[i]
                a = sum(map(widths, left.ids[-width:]))
                b = sum(map(widths, right.ids[:width]))
                whole = width >= len(right.ids)
                runs.append((left.symbols[len(left.symbols) - a :] + right.symbols[:b], whole and right.at_end))
            still = []
            for i, ids in zip(open_joins, self._encode(runs), strict=True):
                left, right = pairs[i]
                left_agrees = width >= len(left.ids) or ids[0] == left.ids[-width]
                right_agrees = width >= len(right.ids) or ids[-1] == right.ids[width - 1]
                if left_agrees and right_agrees:
                    joined = left.ids[:-width] + ids + right.ids[width:]
                    out[i] = Piece(left.symbols + right.symbols, right.at_end, joined)
                else:
                    still.append(i)
            open_joins = still
            width *= 2
        return out

    def pieces(self, pieces: list[str]) -> list[bytes]:
        """Token ids of different pieces, little-endian bytes: the tree for every piece longer than a leaf; a shorter
        one is a leaf by itself."""
        long = [symbols for symbols in pieces if len(symbols) > self.leaf]
        found = dict(zip(long, map(as_bytes, self.encode(long)), strict=True))
        short = [symbols for symbols in pieces if len(symbols) <= self.leaf]
        if short:
            ids, ends = self.bpe.pieces(short)
            body, ends = ids.astype("<u4").tobytes(), (ends * 4).tolist()
            found.update((symbols, body[a:b]) for symbols, a, b in zip(short, [0, *ends], ends))
        return [found[symbols] for symbols in pieces]

    def words(self, words: list[str]) -> list[bytes]:
        """Token ids of words, little-endian bytes: special strings apart, then the library's own normaliser and
        pre-tokeniser, then ``pieces``."""
        plan = [self._pieces(word) for word in words]
        specials, tokenizer = self.bpe.specials, self.bpe.tokenizer
        wanted = list(dict.fromkeys(symbols for steps in plan for symbols in steps if symbols not in specials))
        found = dict(zip(wanted, self.pieces(wanted), strict=True))
        found |= {symbols: as_bytes([tokenizer.token_to_id(symbols)]) for symbols in specials}
        return [b"".join(map(found.__getitem__, steps)) for steps in plan]

    def _pieces(self, word: str) -> list[str]:
        """What the library leaves unsplit of a word, as symbols, and its special strings as they are."""
        if plain := self.bpe.plain(word):
            return [to_symbols(plain[0]), plain[1]] if plain[1] else [to_symbols(plain[0])]
        specials, tokenizer, out = self.bpe.specials, self.bpe.tokenizer, []
        pattern = "|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True))
        for part in re.split(f"({pattern})", word) if specials else [word]:
            if part in specials:
                out.append(part)
                continue
            normal = tokenizer.normalizer.normalize_str(part)
            out += [symbols for symbols, _ in tokenizer.pre_tokenizer.pre_tokenize_str(normal)]
        return out


class TreeWords(WordIds):
    """Token ids of the words of the texts at hand; what is new of a group goes through the tree together."""

    def __init__(self, tree: TreeEncoder) -> None:
        super().__init__(tree.bpe)
        self.tree = tree

    def pieces(self, pieces: list[str]) -> list[bytes]:
        return self.tree.pieces(pieces)

    def others(self, words: list[str]) -> list[bytes]:
        return self.tree.words(words)


def _joined(token: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The texts of rows of ids, laid end to end; ``token`` has the string of each id. An id outside the
    vocabulary or without a string gives nothing."""
    known = (ids >= 0) & (ids < len(token))
    known[known] = pc.greater(pc.binary_length(token), 0).to_numpy(zero_copy_only=False)[ids[known]]
    if not known.all():
        before = np.append(0, np.cumsum(known))
        ends = np.cumsum(sizes, dtype=np.int64)
        ids, sizes = ids[known], before[ends] - before[ends - sizes]
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), token.take(pa.array(ids))), " ")


def _strings(path: str) -> pa.Array:
    return pa.array(word_bpe(path).tokens, pa.string())


def encode(
    docs: DataFrame,
    path: str,
    text: str = "text",
    leaf: int = LEAF,
    decoded: bool = False,
) -> DataFrame:
    """``docs`` with ``ids`` (array of int) in place of ``text``: the library's ids of each whole text,
    without added special tokens; special strings inside texts count as special, as its default.

    With ``decoded``, also what ``decode`` gives for these ids, in the same pass: a task then needs one
    Python worker rather than two. A null or empty text has no ids and decodes to an empty text. Other
    columns are kept as they are; columns named like a result are replaced. Rows and their order within
    a partition stay; nothing is shuffled.
    """
    results = [T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if decoded:
        results.append(T.StructField("decoded", T.StringType()))
    kept = [f for f in docs.schema.fields if f.name not in (text, *[r.name for r in results])]
    schema = T.StructType([*kept, *results])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_cache("bpe", ("tree", path, leaf), lambda: TreeWords(TreeEncoder(word_bpe(path), leaf)))
        strings = _strings(path) if decoded else None
        for batch in batches:
            texts = batch.column(len(names))
            for a, b in ranges(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), CHUNK_BYTES):
                values, sizes = words.texts(texts.slice(a, b - a))
                values = values.view("<i4")
                ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
                columns = [batch.column(i).slice(a, b - a) for i in range(len(names))]
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values)))
                if decoded:
                    columns.append(_joined(strings, values, sizes))
                yield pa.RecordBatch.from_arrays(columns, schema.names)
                del values, columns
                return_free_memory()

    given = docs.select(*[F.col(f"`{n}`") for n in names], F.col(text).cast("string"))
    return map_arrow(given, run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with ``decoded``: the text of ``ids`` as the library decodes them, special tokens kept.

    The vocabulary file names no decoder, so tokens are joined by one space. An id outside the
    vocabulary gives nothing, as in the library. Null ids count as none.
    """
    kept = [f for f in encoded.schema.fields if f.name != "decoded"]
    names = [f.name for f in kept]
    at = names.index("ids")
    schema = T.StructType([*kept, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = _strings(path)
        for batch in batches:
            step = max(1, (4 << 20) * len(batch) // max(1, batch.nbytes))
            for a in range(0, len(batch), step):
                part = batch.slice(a, step)
                column = part.column(at)
                ids = column.flatten().to_numpy(zero_copy_only=False)
                sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([*part.columns, _joined(strings, ids, sizes)], [*names, "decoded"])

    return map_arrow(encoded.select(*[F.col(f"`{n}`") for n in names]), run, schema)
