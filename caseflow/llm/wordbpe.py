"""Byte-level BPE with word ends, word by word, as the tokenizers library encodes whole texts.

A text splits at ASCII white space without changing its tokens: the normaliser maps every run of
white space to one space, composition never crosses a space, no pre-token and no special string
holds one. Words repeat, so every worker keeps the tokens of the words it met in a bounded cache,
and only new words reach the library, many in one call.
"""

from __future__ import annotations

import json
import os
import struct
from collections.abc import Callable, Iterator
from functools import cache
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from caseflow.llm.common import worker_cache

# Words of a generation of a worker's cache, and the longest word worth keeping, in bytes.
CACHED_WORDS = 200_000
CACHED_WORD_BYTES = 256
# Pieces of a line that the library encodes at once; bytes of new words that are taken together.
LINE_PIECES = 500
GROUP_BYTES = 1 << 18


@cache
def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    symbols = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [symbols[b] for b in range(256)]


@cache
def _latin1_to_symbols() -> dict[int, str]:
    return dict(enumerate(byte_symbols()))


def to_symbols(text: str) -> str:
    """``text`` as byte-level symbols, one character for each UTF-8 byte."""
    if text.isascii() and text.isalpha():
        return text
    return text.encode().decode("latin-1").translate(_latin1_to_symbols())


class WordBpe:
    """A tokenizer file with its parts at hand, as the library loads it."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            self._text = file.read()
        spec = json.loads(self._text)
        self.tokenizer = Tokenizer.from_str(self._text)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.end_of_word = spec["model"]["end_of_word_suffix"]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.tokens = [""] * self.size
        for token, i in vocabulary.items():
            self.tokens[i] = token

        suffix = self.end_of_word or ""
        # symbols of each token
        self.widths = np.array([len(t.removesuffix(suffix)) for t in self.tokens], np.int64)
        self._parts: dict[str | None, Tokenizer] = {}

    def part(self, at_end: bool) -> Tokenizer:
        """Encodes byte-level symbols, at the end of words or inside them, as pieces with a space between, each
        unsplit; no symbol is white space."""
        suffix = self.end_of_word if at_end else None
        if suffix not in self._parts:
            spec = json.loads(self._text)
            model = spec["model"] | {"end_of_word_suffix": suffix}
            bare = dict.fromkeys(("normalizer", "pre_tokenizer")) | {"added_tokens": [], "model": model}
            self._parts[suffix] = Tokenizer.from_str(json.dumps(spec | bare))
            self._parts[suffix].pre_tokenizer = WhitespaceSplit()
        return self._parts[suffix]

    def pieces(self, pieces: list[str], at_end: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of unsplit pieces of symbols, end to end, and where those of each piece end.

        Pieces go to the library as lines of many. Tokens cover all symbols, so their widths tell where a piece
        ends; a vocabulary that lacks symbols is asked piece by piece.
        """
        part = self.part(at_end)
        lines = [" ".join(pieces[a : a + LINE_PIECES]) for a in range(0, len(pieces), LINE_PIECES)]
        ids = np.fromiter((i for line in part.encode_batch_fast(lines) for i in line.ids), np.uint32)
        reached, wanted = np.cumsum(self.widths[ids]), np.cumsum([len(p) for p in pieces], dtype=np.int64)
        ends = np.searchsorted(reached, wanted) + 1
        if len(reached) and len(wanted) and ends[-1] == len(ids) and (reached[ends - 1] == wanted).all():
            return ids, ends
        each = [[t.id for t in part.model.tokenize(p)] for p in pieces]
        return np.array([i for ids in each for i in ids], np.uint32), np.cumsum([len(ids) for ids in each], dtype=np.int64)

    def plain(self, word: str) -> tuple[str, str] | None:
        """``(letters, tail)`` of a word of Latin letters, lower case, and maybe ASCII punctuation behind.

        None for any other word. Below U+0130 lower case maps one letter to one, nothing composes,
        and the letters are one pre-token; punctuation without a letter or digit behind it is another.
        """
        core = word.rstrip(punctuation)
        if core.isalpha() and (core.isascii() or max(core) < "İ"):
            return core.lower(), word[len(core) :]
        return None


def as_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def word_bpe(path: str) -> WordBpe:
    """One instance for each process. A task has one core, so the library's threads, each of which
    would hold memory of its own, are left out."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return worker_cache("bpe", ("file", path), lambda: WordBpe(path))


class WordCache(dict):
    """Values of words, each computed when it is first asked for.

    When the cache is full it becomes the older generation, from which words that come again are
    taken over; so it stays bounded and keeps the words that are frequent. Long words are not kept.
    """

    def __init__(self, compute: Callable[[str], object]) -> None:
        super().__init__()
        self.compute = compute
        self.older: dict[bytes, object] = {}

    def __missing__(self, word: bytes) -> object:
        value = self.older.get(word)
        if value is None:
            value = self.compute(word.decode("utf-8", "replace"))
        if len(word) <= CACHED_WORD_BYTES:
            if len(self) >= CACHED_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = value
        return value


# Words of a generation where one cache holds all that a text is made of.
CACHED_TEXT_WORDS = 400_000


def _groups(words: list[bytes]) -> Iterator[list[bytes]]:
    """``words`` in groups of about GROUP_BYTES, so that little is at hand at once besides the cache."""
    group, size = [], 0
    for word in words:
        if group and size + len(word) > GROUP_BYTES:
            yield group
            group, size = [], 0
        group.append(word)
        size += len(word)
    if group:
        yield group


# Letters below U+0130; lower case maps one of them to one.
_LETTERS = "".join(c for c in map(chr, range(0x130)) if c.isalpha())


def valid(texts: pa.Array) -> pa.Array:
    """A string column with empty texts for nulls and replacement characters for bytes that are no UTF-8."""
    texts = pc.fill_null(texts, "")
    try:
        texts.validate(full=True)
    except pa.ArrowInvalid:
        texts = pa.array([t.decode("utf-8", "replace") for t in texts.cast(pa.binary()).to_pylist()], pa.string())
    return texts


class WordIds:
    """Token ids of words, as little-endian bytes, in two generations: when the cache is full it becomes the older
    one, from which words that come again are taken over. Long words are not kept.

    A word of Latin letters, maybe with punctuation behind, is the word of its letters in lower case and that of
    its tail (see ``WordBpe.plain``); only these are kept, and most words that are new in a text need no merging.
    """

    def __init__(self, bpe: WordBpe) -> None:
        self.bpe = bpe
        self.kept: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of different unsplit pieces of symbols."""
        ids, ends = self.bpe.pieces(pieces)
        body, ends = ids.astype("<u4").tobytes(), (ends * 4).tolist()
        return [body[a:b] for a, b in zip([0, *ends], ends)]

    def others(self, words: list[str]) -> list[bytes]:
        """Ids of words that are not plain."""
        return [as_bytes(e.ids) for e in self.bpe.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words in lower case, tails, and words that are not plain."""
        pieces: dict[bytes, str] = {}
        others: dict[bytes, str] = {}
        for word in words:
            text = word.decode()
            plain = self.bpe.plain(text)
            if plain and not plain[1]:
                pieces[word] = to_symbols(plain[0])
            else:
                others[word] = text
        found = dict(zip(pieces, self.pieces(list(pieces.values())), strict=True)) if pieces else {}
        if others:
            found.update(zip(others, self.others(list(others.values())), strict=True))
        return found

    def words(self, words: list[bytes]) -> list[bytes]:
        """Ids of different words in lower case, tails, and words that are not plain."""
        if len(self.kept) > CACHED_TEXT_WORDS:
            self.kept, self.older = {}, self.kept
        kept, older = self.kept, self.older
        found = list(map(kept.get, words))
        new: list[int] = []
        for i, ids in enumerate(found):
            if ids is None:
                found[i] = ids = older.get(words[i])
                if ids is None:
                    new.append(i)
                else:
                    kept[words[i]] = ids
        learned: dict[bytes, bytes] = {}
        for group in _groups([words[i] for i in new]):
            learned |= self._learn(group)
        for i in new:
            found[i] = learned[words[i]]
        kept.update((word, ids) for word, ids in learned.items() if len(word) <= CACHED_WORD_BYTES)
        return found

    def distinct(self, words: pa.Array) -> pa.Array:
        """Ids of each of ``words``, valid UTF-8, as a binary column."""
        core, tail = pc.ascii_rtrim(words, punctuation), pc.utf8_ltrim(words, _LETTERS)
        size = pc.binary_length(core)
        plain = pc.and_(pc.greater(size, 0), pc.equal(pc.add(size, pc.binary_length(tail)), pc.binary_length(words)))
        cores, tails = pc.if_else(plain, pc.utf8_lower(core), words), pc.if_else(plain, tail, "")
        parts = pa.concat_arrays([cores, tails]).dictionary_encode()
        known = self.words(parts.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist())
        ids = pa.array(known, pa.large_binary())
        first, second = (ids.take(parts.indices.slice(at, len(words))) for at in (0, len(words)))
        return pc.binary_join_element_wise(first, second, pa.scalar(b"", pa.large_binary()))

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a string column, end to end, and how many each text has; a null text has none."""
        split = pc.ascii_split_whitespace(valid(texts))
        words = split.flatten().dictionary_encode()
        ids = self.distinct(words.dictionary)
        sizes = (pc.binary_length(ids).to_numpy() // 4)[words.indices.to_numpy()]
        ends = np.append(0, np.cumsum(sizes))
        body = ids.take(words.indices).buffers()[2]
        out = np.frombuffer(body, "<u4", int(ends[-1])) if ends[-1] else np.zeros(0, "<u4")
        return out, np.diff(ends[np.append(0, np.cumsum(pc.list_value_length(split).to_numpy()))])

    def of(self, texts: list[list[bytes]]) -> list[bytes]:
        """The ids of every text, a list of its words."""
        ids, sizes = self.texts(pa.array([b" ".join(words) for words in texts], pa.binary()).view(pa.string()))
        return [part.tobytes() for part in np.split(ids, np.cumsum(sizes)[:-1])]


def text_ids(path: str, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of a string column, end to end, as unsigned 32-bit integers, and how many each text has."""
    return worker_cache("bpe", ("ids", path), lambda: WordIds(word_bpe(path))).texts(texts)


def encode_texts(path: str, texts: list[bytes]) -> list[np.ndarray]:
    """Token ids of every text, as unsigned 32-bit integers."""
    ids, sizes = text_ids(path, pa.array(texts, pa.binary()).view(pa.string()))
    return np.split(ids, np.cumsum(sizes)[:-1]) if len(sizes) else []
