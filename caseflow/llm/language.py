"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary. The probability of a word
is the sum over all ways to cut it into pieces, by the forward algorithm; that of a text is the product
over its words (runs of letters, lower-cased, behind a word-start mark). Piece probabilities are learned
by expectation maximisation over the same segmentations.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.llm.common import (
    chunks,
    map_arrow,
    materialise,
    return_free_memory,
    text_bytes,
    without_caches,
    worker_cache,
)

UNDETERMINED = "und"
# Rows of each language that the fit reads, on average; which ones follows from a hash of doc_id.
TRAIN_ROWS = 1500
ROUNDS = 2
# Expected counts added to every piece; keeps unseen pieces possible in every language.
SMOOTHING = 0.05
MARK = "▁"
# Words of a generation of a worker's cache.
CACHED_WORDS = 100_000
WORDS_AT_ONCE = 1 << 13
# Bytes of text whose words a worker holds at once; a longer text is held alone.
CHUNK_BYTES = 1 << 20
_WORD = re.compile(r"[^\W\d_]+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Pieces:
    """What pieces of letters begin with, the longest piece included, as sorted hashes by length; an unknown single
    character is the last piece."""

    by_length: list[tuple[np.ndarray, np.ndarray]]  # hashes, numbers of those that are pieces, else -1
    size: int


def _hash(parts: list[np.ndarray]) -> np.ndarray:
    value = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        value = (value + part) * _FACTOR
        value ^= value >> np.uint64(29)
    return value


@cache
def pieces(path: str) -> Pieces:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = set()
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i).lower()
        letters = piece.removeprefix(MARK)
        if letters.isalpha() or piece == MARK:
            kept.add(piece)
    kept.add(MARK)
    ordered = sorted(kept)
    number = {p: n for n, p in enumerate(ordered)}
    by_length = []
    for length in range(1, max(map(len, ordered)) + 1):
        own = sorted({p[:length] for p in ordered if len(p) >= length})
        hashes = _hash([np.array([ord(p[i]) for p in own], np.uint64) for i in range(length)])
        order = np.argsort(hashes)
        by_length.append((hashes[order], np.array([number.get(p, -1) for p in own], np.int64)[order]))
    return Pieces(by_length, len(ordered) + 1)


def lattice(vocabulary: Pieces, points: np.ndarray) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """For words of one length (rows of code points), the pieces found at each (begin, length): the
    rows and their piece numbers. Rows with which no longer piece begins are left out of the next length."""
    found = {}
    width, longest = points.shape[1], len(vocabulary.by_length)
    for begin in range(width):
        rows, value = np.arange(len(points)), np.zeros(len(points), np.uint64)
        for length in range(1, min(longest, width - begin) + 1):
            value = (value + points[rows, begin + length - 1]) * _FACTOR
            value ^= value >> np.uint64(29)
            hashes, numbers = vocabulary.by_length[length - 1]
            at = np.minimum(np.searchsorted(hashes, value), len(hashes) - 1)
            known = hashes[at] == value
            number = np.where(known, numbers[at], -1)
            if length == 1:
                found[begin, 1] = rows, np.where(number >= 0, number, vocabulary.size - 1)
            elif (number >= 0).any():
                found[begin, length] = rows[number >= 0], number[number >= 0]
            rows, value = rows[known], value[known]
            if not len(rows):
                break
    return found


def forward(
    cells: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]], n: int, width: int, probability: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward sums (width + 1, n, languages) and log scales by position: the sum over all
    segmentations of what lies before each position. Scaling keeps words of any length representable."""
    languages = probability.shape[1]
    longest = max((length for _, length in cells), default=1)
    sums = np.zeros((width + 1, n, languages))
    scale = np.zeros((width + 1, n, 1))
    sums[0] = 1
    for end in range(1, width + 1):
        total = sums[end]
        for length in range(1, min(longest, end) + 1):
            if (end - length, length) not in cells:
                continue
            rows, numbers = cells[end - length, length]
            carried = np.exp(scale[end - length, rows] - scale[end - 1, rows])
            total[rows] += sums[end - length, rows] * probability[numbers] * carried
        top = total.max(axis=1, keepdims=True)
        total /= top
        scale[end] = scale[end - 1] + np.log(top)
    return sums, scale


def plain_forward(
    cells: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]], n: int, width: int, probability: np.ndarray
) -> np.ndarray:
    """The forward sums of whole words that are too short to need a scale."""
    sums = np.zeros((width + 1, n, probability.shape[1]))
    sums[0] = 1
    longest = max((length for _, length in cells), default=1)
    for end in range(1, width + 1):
        for length in range(1, min(longest, end) + 1):
            if (end - length, length) not in cells:
                continue
            rows, numbers = cells[end - length, length]
            if len(rows) == n:
                sums[end] += sums[end - length] * probability[numbers]
            else:
                sums[end, rows] += sums[end - length, rows] * probability[numbers]
    return sums[width]


def _code_rows(words: list[str]) -> np.ndarray:
    flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    return flat.reshape(len(words), -1).astype(np.uint64)


def _by_length(words: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Places and words of equal length, a bounded number at a time."""
    groups: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        groups.setdefault(len(word), []).append(i)
    for length, places in sorted(groups.items()):
        step = max(1, WORDS_AT_ONCE * 8 // length)
        for at in range(0, len(places), step):
            some = places[at : at + step]
            yield some, [words[i] for i in some]


def log_likelihoods(vocabulary: Pieces, probability: np.ndarray, words: list[str]) -> np.ndarray:
    """Natural logarithm of each marked word's probability in every language."""
    out = np.zeros((len(words), probability.shape[1]))
    least = probability.min() if probability.size else 0
    for places, some in _by_length(words):
        points = _code_rows(some)
        width, cells = points.shape[1], lattice(vocabulary, points)
        if least > 0 and width * -np.log10(least) < 290:
            out[places] = np.log(plain_forward(cells, len(some), width, probability))
            continue
        sums, scale = forward(cells, len(some), width, probability)
        out[places] = np.log(np.maximum(sums[width], 1e-300)) + scale[width]
    return out


def expected_counts(vocabulary: Pieces, probability: np.ndarray, words: list[str], weight: np.ndarray) -> np.ndarray:
    """Expected uses of every piece over all segmentations; ``weight`` is words by languages."""
    out = np.zeros((vocabulary.size, probability.shape[1]))
    for places, some in _by_length(words):
        points = _code_rows(some)
        width, n = points.shape[1], len(some)
        cells = lattice(vocabulary, points)
        longest = max((length for _, length in cells), default=1)
        sums, scale = forward(cells, n, width, probability)
        ahead = np.zeros_like(sums)  # what lies behind each position, relative to the whole word
        ahead[width] = weight[places] / np.maximum(sums[width], 1e-300)
        for begin in range(width - 1, -1, -1):
            for length in range(1, min(longest, width - begin) + 1):
                if (begin, length) not in cells:
                    continue
                rows, numbers = cells[begin, length]
                carried = np.exp(scale[begin, rows] - scale[begin + length, rows])
                behind = ahead[begin + length, rows] * probability[numbers] * carried
                ahead[begin, rows] += behind
                used = sums[begin, rows] * behind
                for language in range(probability.shape[1]):
                    out[:, language] += np.bincount(numbers, used[:, language], vocabulary.size)
    return out


@dataclass
class Model:
    languages: list[str]
    probability: np.ndarray  # pieces by languages
    path: str


def letter_runs(text: str) -> list[str]:
    """Runs of letters (Unicode category L). A word may hold numerals other than decimal digits, such as a half
    or a Roman eight; these are no letters and part it."""
    found = _WORD.findall(text)
    if all(map(str.isalpha, found)):
        return found
    return [run for word in found for run in "".join(c if c.isalpha() else " " for c in word).split()]


def _words(text: str) -> list[str]:
    return letter_runs(text.lower())


def word_counts(rows: DataFrame) -> DataFrame:
    """lang, word, n over the texts of ``rows`` (lang, text), summed within tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        without_caches("language")
        for batch in batches:
            counts: dict[tuple[str, str], int] = {}
            for lang, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                for word in _words(text.decode("utf-8", "replace")):
                    counts[lang, word] = counts.get((lang, word), 0) + 1
            keys = list(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                 pa.array(list(counts.values()), pa.int64())],
                ["lang", "word", "n"],
            )

    partial = map_arrow(rows.select("lang", "text"), run, "lang string, word string, n long")
    return partial.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, path: str, train_rows: int = TRAIN_ROWS, rounds: int = ROUNDS) -> Model:
    """Fit piece probabilities on labelled rows of ``docs`` (doc_id, text, lang).

    About ``train_rows`` rows of each language are used, whole texts, chosen by a hash of doc_id: the
    documented bound of the fit. Rows without a language or text teach nothing. Every round is a Spark
    job over the words; expected counts come back as one row for each piece and language.
    """
    labelled = docs.filter("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    vocabulary = pieces(path)
    probability = np.full((vocabulary.size, len(languages)), 1 / vocabulary.size)
    if not languages:
        return Model([], probability, path)
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, train_rows / sizes[k]))])
    luck = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("fit")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    words = materialise(word_counts(labelled.filter(luck < share[F.col("lang")])), "words")
    words = words.groupBy("word").agg(
        F.array(*[F.sum(F.when(F.col("lang") == k, F.col("n")).otherwise(0)) for k in languages]).alias("n")
    )
    words = materialise(words, "word-counts")
    for _ in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], probability=probability) -> Iterator[pa.RecordBatch]:
            without_caches("language")
            known = pieces(path)
            total = np.zeros((known.size, len(languages)))
            for batch in batches:
                some = [MARK + w for w in batch.column(0).to_pylist()]
                weight = np.array(batch.column(1).to_pylist(), np.float64)
                if len(some):
                    total += expected_counts(known, probability, some, weight)
            used, language = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), pa.array(language), pa.array(total[used, language])], ["piece", "lang", "n"]
            )

        expected = map_arrow(words, run, "piece long, lang long, n double")
        counts = np.full((vocabulary.size, len(languages)), SMOOTHING)
        for row in expected.groupBy("piece", "lang").agg(F.sum("n").alias("n")).collect():
            counts[row["piece"], row["lang"]] += row["n"]
        probability = counts / counts.sum(axis=0)
    return Model(languages, probability, path)


class Scorer:
    """Log-likelihoods of whole texts; white-space words a worker has met are looked up. When there are too many they
    become the older generation, from which words that come again are taken over."""

    def __init__(self, model: Model) -> None:
        self.model, self.vocabulary = model, pieces(model.path)
        self.row: dict[str, int] = {}
        self.values = np.zeros((0, len(model.languages)))
        self.older = self.row, self.values

    def add(self, words: list[str]) -> None:
        if len(self.row) > CACHED_WORDS:
            self.older = self.row, self.values
            self.row, self.values = {}, self.values[:0]
        wanted = set(words).difference(self.row)
        again = list(wanted.intersection(self.older[0]))
        self._keep(again, self.older[1][[self.older[0][w] for w in again]])
        new = list(wanted.difference(again))
        runs = [letter_runs(w) for w in new]
        parts = list({r for rs in runs for r in rs})
        scores = log_likelihoods(self.vocabulary, self.model.probability, [MARK + p for p in parts])
        at = {p: i for i, p in enumerate(parts)}
        sizes = np.array([len(rs) for rs in runs], np.int64)
        sums = np.zeros((len(new), self.values.shape[1]))
        if sizes.any():
            own = np.array([at[r] for rs in runs for r in rs])
            sums[sizes > 0] = np.add.reduceat(scores[own], (np.cumsum(sizes) - sizes)[sizes > 0])
        self._keep(new, sums)

    def _keep(self, words: list[str], values: np.ndarray) -> None:
        begin = len(self.values)
        if words:
            self.values = np.concatenate([self.values, values])
            self.row.update(zip(words, range(begin, begin + len(words)), strict=True))

    def predict(self, texts: list[bytes]) -> tuple[list[str], list[float]]:
        if not self.model.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        words = [t.decode("utf-8", "replace").lower().split() for t in texts]
        self.add([w for ws in words for w in ws])
        languages, scores = [], []
        for ws in words:
            total = self.values[list(map(self.row.__getitem__, ws))].sum(axis=0) if ws else np.zeros(0)
            if not len(total) or not total.any():  # no letter: every word has probability one
                languages.append(UNDETERMINED)
                scores.append(0.0)
                continue
            best = int(total.argmax())
            languages.append(self.model.languages[best])
            scores.append(float(1 / np.exp(total - total[best]).sum()))
        return languages, scores


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the posterior of that language under equal priors.

    A text that is null, empty or without a letter is ``und`` with score 0, as is every text under a
    model that has learned no language; equal likelihoods go to the language first by name. Whole texts
    are scored; nothing is shuffled. Columns named like a result are replaced, others kept.
    """
    results = ("lang_pred", "score")
    kept = [f for f in docs.schema.fields if f.name not in results]
    names = [f.name for f in kept]
    at = names.index(text)
    held = docs.sparkSession.sparkContext.broadcast(model)  # pieces by languages, whatever the corpus
    family = f"language {uuid.uuid4().hex}"  # another model's words go

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = worker_cache(family, "scorer", lambda: Scorer(held.value))
        for batch in batches:
            languages, scores = [], []
            texts = text_bytes(batch.column(at))
            for a, b in chunks(texts, CHUNK_BYTES):
                some = scorer.predict(texts[a:b])
                languages += some[0]
                scores += some[1]
                return_free_memory()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                [*names, *results],
            )

    schema = T.StructType([*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return map_arrow(docs.select(*[F.col(f"`{n}`") for n in names]), run, schema)
