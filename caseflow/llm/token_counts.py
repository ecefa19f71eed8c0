"""Token counts by the whole-token shortcut.

``whole_tokens`` proves from the vocabulary alone which strings encode as a single token. A pre-token
among them counts as one without any merging; only the others are merged, once for each new word a
worker meets.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.llm.common import map_arrow, text_bytes, worker_cache
from caseflow.llm.wordbpe import WordBpe, WordCache, to_symbols, word_bpe


def whole_tokens(bpe: WordBpe) -> frozenset[str]:
    """Pre-tokens, as byte-level symbols, whose encoding is one token: every vocabulary string that
    can stand for a whole pre-token is encoded alone and kept if its own id comes back."""
    suffix = bpe.end_of_word or ""
    specials = set(bpe.specials)
    found = set()
    for i, token in enumerate(bpe.tokens):
        if not token or token in specials or not token.endswith(suffix):
            continue
        symbols = token.removesuffix(suffix) if suffix else token
        if symbols and [t.id for t in bpe.model.tokenize(symbols)] == [i]:
            found.add(symbols)
    return frozenset(found)


class Counter:
    """Counts of single words, by the shortcut first."""

    def __init__(self, path: str) -> None:
        self.bpe = word_bpe(path)
        self.whole = whole_tokens(self.bpe)
        specials = sorted(self.bpe.specials, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None
        self.cache = WordCache(self.word)

    def pre_token(self, symbols: str) -> int:
        return 1 if symbols in self.whole else len(self.bpe.model.tokenize(symbols))

    def word(self, word: str) -> int:
        if plain := self.bpe.plain(word):
            return sum(self.pre_token(to_symbols(piece)) for piece in plain if piece)
        n = 0
        if self.special is not None and "<" in word:
            n = len(self.special.findall(word))
            parts = self.special.split(word)
        else:
            parts = [word]
        for part in parts:
            normal = self.bpe.tokenizer.normalizer.normalize_str(part)
            pre_tokens = self.bpe.tokenizer.pre_tokenizer.pre_tokenize_str(normal)
            n += sum(self.pre_token(symbols) for symbols, _ in pre_tokens)
        return n


def count_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8) and ``n_tokens`` in place of ``text``.

    Tokens of the whole text as the library gives them: none added, special strings inside the text
    count as special, no truncation or padding. A null or empty text has 0 of both. Other columns
    are kept; one that is named like a result is replaced. Nothing is shuffled.
    """
    results = ("n_bytes", "n_tokens")
    kept = [f for f in docs.schema.fields if f.name not in (text, *results)]
    names = [f.name for f in kept]
    schema = T.StructType([*kept, *[T.StructField(n, T.LongType()) for n in results]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_cache("bpe", ("counts", path), lambda: Counter(path)).cache.__getitem__
        for batch in batches:
            texts = text_bytes(batch.column(len(names)))
            counts = [sum(map(known, t.split())) for t in texts]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], sizes, pa.array(counts, pa.int64())], [*names, *results]
            )

    given = docs.select(*[F.col(f"`{n}`") for n in names], F.col(text).cast("string"))
    return map_arrow(given, run, schema)
