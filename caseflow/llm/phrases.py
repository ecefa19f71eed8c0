"""Phrases whose words come together more often than apart, counted in burstable tries.

A task counts phrases in a HAT-trie: a shallow trie over word ids whose leaves are hash containers, a
container bursting into a branch when it has grown. When the trie is over its budget, whole subtrees, the
largest first, leave it as runs sorted by phrase. Runs meet at the partition of their prefix, the first two
words, and are merged there. Words are counted first, then pairs of frequent words, then longer phrases of
frequent pairs: a phrase is never more frequent than a part of it, so nothing frequent is missed. What is
frequent reaches the tasks as a bit filter of fixed size, which may let a rare phrase pass and never stops
a frequent one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseflow.llm.blocks import runs
from caseflow.llm.common import map_arrow, materialise, worker_cache

UNKNOWN_LANGUAGE = "und"
LONGEST = 4
_ID_BITS = 21

# Breaks become full stops, tabs become spaces, A-Z become small letters.
_FOLD = bytes(46 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_SEPARATOR = re.compile(rb"[ .]")


class Limits(NamedTuple):
    """How much is held at once; no result depends on it."""

    burst: int = 2048  # a container of more phrases bursts
    trie_phrases: int = 700_000  # a task's tries are emptied by half beyond this
    task_words: int = 300_000  # and wholly, with the word lists, beyond this
    flush_words: int = 500_000
    slice_bytes: int = 1 << 20
    filter_bits: int = 1 << 27  # 16 MB for each task that asks what is frequent, whatever the corpus


class Branch(dict):
    """A burst container: next word id to container or branch."""


class HatTrie:
    """Counts of phrases of ``length`` word ids. A container maps the ids that are left, packed, to a count."""

    def __init__(self, length: int, burst: int) -> None:
        self.left, self.burst = length - 1, burst
        self.root = Branch()
        self.phrases = 0

    def add(self, first: np.ndarray, rest: np.ndarray, counts: np.ndarray) -> None:
        """Phrases as first id and packed rest, each once, in ascending order."""
        begins = runs(first)
        bounds = [*begins.tolist(), len(first)]
        keys, numbers = rest.tolist(), counts.tolist()
        for word, begin, end in zip(first[begins].tolist(), bounds, bounds[1:], strict=False):
            node = self.root.get(word)
            if isinstance(node, Branch):
                self._into(self.root, word, rest[begin:end], counts[begin:end], self.left)
                continue
            if node is None:
                node = self.root[word] = {}
            before = len(node)
            for key, count in zip(keys[begin:end], numbers[begin:end], strict=True):
                node[key] = node.get(key, 0) + count
            self.phrases += len(node) - before
            if self.left > 1 and len(node) > self.burst:
                self._burst(self.root, word, self.left)

    def _burst(self, branch: Branch, word: int, left: int) -> None:
        shift = _ID_BITS * (left - 1)
        burst = Branch()
        for key, count in branch[word].items():
            burst.setdefault(key >> shift, {})[key & ((1 << shift) - 1)] = count
        branch[word] = burst

    def _into(self, branch: Branch, word: int, rest: np.ndarray, counts: np.ndarray, left: int) -> None:
        node = branch.get(word)
        if node is None:
            node = branch[word] = {}
        if isinstance(node, Branch):
            shift = _ID_BITS * (left - 1)
            words = rest >> shift
            bounds = [*runs(words).tolist(), len(words)]
            for begin, end in zip(bounds, bounds[1:], strict=False):
                tail = rest[begin:end] & ((1 << shift) - 1)
                self._into(node, int(words[begin]), tail, counts[begin:end], left - 1)
            return
        before = len(node)
        for key, count in zip(rest.tolist(), counts.tolist(), strict=True):
            node[key] = node.get(key, 0) + count
        self.phrases += len(node) - before
        if left > 1 and len(node) > self.burst:
            self._burst(branch, word, left)

    def _walk(self, node: dict, path: tuple[int, ...], left: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Word ids, a row for each phrase, and counts of every container below ``node``."""
        if isinstance(node, Branch):
            for word, child in node.items():
                yield from self._walk(child, (*path, word), left - 1)
        else:
            keys = np.fromiter(node.keys(), np.int64, len(node))
            ids = np.empty((len(node), len(path) + left), np.int32)
            ids[:, : len(path)] = path
            for i in range(left):
                ids[:, len(path) + i] = (keys >> (_ID_BITS * (left - 1 - i))) & ((1 << _ID_BITS) - 1)
            yield ids, np.fromiter(node.values(), np.int64, len(node))

    def _size(self, node: dict) -> int:
        return sum(map(self._size, node.values())) if isinstance(node, Branch) else len(node)

    def pop(self, keep: int) -> Iterator[tuple[int, dict]]:
        """Removes whole subtrees, the largest first, until at most ``keep`` phrases are left, and gives each
        with its first word."""
        for size, word in sorted(((self._size(child), word) for word, child in self.root.items()), reverse=True):
            if self.phrases <= keep:
                return
            self.phrases -= size
            yield word, self.root.pop(word)

    def unpacked(self, word: int, node: dict) -> list[tuple[np.ndarray, np.ndarray]]:
        """Word ids and counts of the containers of a subtree."""
        return list(self._walk(node, (word,), self.left))

    def take(self, keep: int) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
        """The subtrees of :meth:`pop`, unpacked."""
        return (self.unpacked(word, node) for word, node in self.pop(keep))

    def together(self, nodes: list[tuple[int, dict]]) -> tuple[np.ndarray, np.ndarray]:
        """Word ids and counts of many subtrees that are single containers."""
        keys, counts = [], []
        for _, node in nodes:
            keys.extend(node)
            counts.extend(node.values())
        rest = np.array(keys, np.int64)
        ids = np.empty((len(rest), self.left + 1), np.int32)
        ids[:, 0] = np.repeat([word for word, _ in nodes], [len(node) for _, node in nodes])
        for i in range(self.left):
            ids[:, i + 1] = (rest >> (_ID_BITS * (self.left - 1 - i))) & ((1 << _ID_BITS) - 1)
        return ids, np.array(counts, np.int64)


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A hash of two words from the hashes of each; their order matters."""
    mixed = first * np.uint64(0x9E3779B97F4A7C15) + second
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


class Words(dict):
    """Ids of the words of a language in a task, from 1 on; 0 is a break. Hashes do not depend on the task."""

    def __init__(self, language: str) -> None:
        super().__init__({b".": 0})
        self.seed = xxhash.xxh64_intdigest(language.encode(), 42)
        self.names = [b"."]
        self._hashes = np.zeros(1, np.uint64)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.names)
        self.names.append(word)
        return number

    def hashes(self) -> np.ndarray:
        if len(self._hashes) < len(self.names):
            new = [xxhash.xxh64_intdigest(w, self.seed) for w in self.names[len(self._hashes) :]]
            self._hashes = np.concatenate([self._hashes, np.array(new, np.uint64)])
        return self._hashes


def slices(text: bytes, size: int) -> Iterator[bytes]:
    """``text`` folded, in slices of about ``size`` bytes that end between words."""
    folded = text.translate(_FOLD)
    at = 0
    while len(folded) - at > size:
        cut = _SEPARATOR.search(folded, at + size)
        if cut is None:
            break
        yield folded[at : cut.start()]
        at = cut.start()
    yield folded[at:]


class Counter:
    """Phrases of one language in a task, of the given lengths; ``frequent`` holds the filter of their parts."""

    def __init__(
        self, language: str, lengths: tuple[int, ...], frequent: np.ndarray | None, limits: Limits
    ) -> None:
        self.language, self.lengths, self.frequent, self.limits = language, lengths, frequent, limits
        self.words = Words(language)
        self.tries = {n: HatTrie(n, limits.burst) for n in lengths}
        self._held: list[np.ndarray] = []
        self._waiting = self._counted = 0

    def read(self, text: bytes) -> None:
        for part in slices(text, self.limits.slice_bytes):
            found = part.replace(b".", b" . ").split()
            self._held.append(np.fromiter(map(self.words.__getitem__, found), np.int64, len(found)))
            self._waiting += len(found)
            if self._waiting >= self.limits.flush_words:
                self.flush()
        self._held.append(np.zeros(1, np.int64))

    def flush(self) -> None:
        """Counts what was read. The last words stay, in front of what comes, for phrases that go on there."""
        if not self._held:
            return
        ids = np.concatenate(self._held)
        if self.frequent is None:
            good = ids > 0
        elif self.lengths == (2,):
            good = (ids > 0) & self._among(self.words.hashes())[ids]
        else:
            hashes = self.words.hashes()[ids]
            good = (ids[:-1] > 0) & (ids[1:] > 0)
            good[good] = self._among(pair_hash(hashes[:-1][good], hashes[1:][good]))
        step = len(ids) - len(good)  # parts of two words begin at all places but the last
        for length in self.lengths:
            places = max(0, len(ids) - length + 1)
            chosen = np.ones(places, bool)
            for i in range(length - step):
                chosen &= good[i : i + places]
            # a phrase that ends inside the words kept from before was counted then
            chosen[: max(0, self._counted - length + 1)] = False
            self._add(ids, np.flatnonzero(chosen), length)
        kept = ids[-(LONGEST - 1) :]
        self._held, self._waiting, self._counted = [kept], 0, len(kept)

    def _among(self, hashes: np.ndarray) -> np.ndarray:
        bit = hashes % np.uint64(8 * len(self.frequent))
        return (self.frequent[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def _add(self, ids: np.ndarray, at: np.ndarray, length: int) -> None:
        if not len(at):
            return
        first, rest = ids[at], np.zeros(len(at), np.int64)
        for i in range(1, length):
            rest = (rest << _ID_BITS) | ids[at + i]
        if length < LONGEST:  # the whole phrase in one number
            bits = _ID_BITS * (length - 1)
            key = np.sort((first << bits) | rest)
            first, rest = key >> bits, key & ((1 << bits) - 1)
            begins = runs(key)
        else:
            order = np.lexsort((rest, first))
            first, rest = first[order], rest[order]
            begins = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (rest[1:] != rest[:-1])]))
        self.tries[length].add(first[begins], rest[begins], np.diff(np.append(begins, len(first))))

    def phrases(self) -> int:
        return sum(trie.phrases for trie in self.tries.values())

    def spill(self, share: float) -> Iterator[pa.RecordBatch]:
        """Subtrees as sorted runs until at most ``share`` of the phrases is left."""
        names = pa.array(self.words.names, pa.binary())
        for trie in self.tries.values():
            nodes: list[tuple[int, dict]] = []
            waiting = 0
            for word, node in trie.pop(int(share * trie.phrases)):
                if isinstance(node, Branch):
                    yield self._run(trie.unpacked(word, node), names)
                    continue
                nodes.append((word, node))
                waiting += len(node)
                if waiting >= 100_000:
                    yield self._run([trie.together(nodes)], names)
                    nodes, waiting = [], 0
            if nodes:
                yield self._run([trie.together(nodes)], names)

    def _run(self, parts: list[tuple[np.ndarray, np.ndarray]], names: pa.Array) -> pa.RecordBatch:
        """Whole subtrees in the order of their phrases."""
        ids = np.concatenate([ids for ids, _ in parts])
        counts = np.concatenate([counts for _, counts in parts])
        words = [pc.take(names, pa.array(ids[:, i])) for i in range(ids.shape[1])]
        phrases = pc.binary_join_element_wise(*words, b" ") if len(words) > 1 else words[0]
        order = pc.sort_indices(phrases)
        columns = {"lang": pa.array([self.language] * len(ids)), "phrase": pc.take(phrases, order).cast(pa.string())}
        if len(words) > 2:
            hashes = self.words.hashes()
            prefix = pair_hash(hashes[ids[:, 0]], hashes[ids[:, 1]]).view(np.int64)
            columns = {"prefix": pa.array(prefix[order.to_numpy()])} | columns
        columns["f"] = pa.array(counts[order.to_numpy()])
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _counting(lengths: tuple[int, ...], frequent, limits: Limits):
    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("phrases", "none", dict)  # what other operators keep in the process goes
        bits = frequent.value if frequent is not None else None
        counters: dict[str, Counter] = {}
        for batch in given:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for text, language in zip(texts, batch.column("lang").to_pylist(), strict=True):
                if language not in counters:
                    counters[language] = Counter(language, lengths, bits, limits)
                counters[language].read(text or b"")
                if sum(c.phrases() for c in counters.values()) > limits.trie_phrases:
                    for counter in counters.values():
                        yield from counter.spill(0.5)
                if sum(len(c.words) for c in counters.values()) > limits.task_words:
                    for counter in counters.values():
                        counter.flush()
                        yield from counter.spill(0)
                    counters.clear()
        for counter in counters.values():
            counter.flush()
            yield from counter.spill(0)

    return run


def _count(texts: DataFrame, lengths: tuple[int, ...], limits: Limits, frequent=None) -> DataFrame:
    """``lang, phrase, f``: runs of all tasks, merged per prefix partition. The prefix is the first two words: of a
    shorter phrase it is the phrase, and of a longer one a hash that travels with it."""
    prefix = ["prefix"] if max(lengths) > 2 else []
    schema = "".join(f"{name} long, " for name in prefix) + "lang string, phrase string, f long"
    dealt = map_arrow(texts, _counting(lengths, frequent, limits), schema)
    dealt = dealt.repartition(*(prefix or ["lang", "phrase"]))
    return dealt.groupBy(*prefix, "lang", "phrase").agg(F.sum("f").alias("f")).drop(*prefix)


def _bits_of(size: int):
    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            bits = []
            for language, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True):
                seed = xxhash.xxh64_intdigest(language.encode(), 42)
                hashes = [np.array([xxhash.xxh64_intdigest(w, seed)], np.uint64) for w in phrase.encode().split(b" ")]
                bits.append(int((hashes[0] if len(hashes) == 1 else pair_hash(*hashes))[0]) % size)
            yield pa.RecordBatch.from_arrays([pa.array(bits, pa.int64())], names=["bit"])

    return run


_BITS_A_ROW = 32_768


def _filter(frequent: DataFrame, size: int):
    """A broadcast of ``size`` bits, with those of the given words or pairs set."""
    bits = map_arrow(frequent.select("lang", "phrase"), _bits_of(size), "bit long")
    row, place = F.expr(f"bit div {_BITS_A_ROW}"), F.col("bit") % _BITS_A_ROW
    rows = bits.groupBy(row.alias("row")).agg(F.bitmap_construct_agg(place).alias("bits"))
    held = np.zeros(max(size, _BITS_A_ROW) // 8, np.uint8)
    for found in rows.toLocalIterator():
        begin = found["row"] * (_BITS_A_ROW // 8)
        held[begin : begin + _BITS_A_ROW // 8] = np.frombuffer(bytes(found["bits"]), np.uint8)
    return frequent.sparkSession.sparkContext.broadcast(held[: size // 8])


def _part(words: Column, begin, length) -> Column:
    return F.array_join(F.slice(words, begin, length), " ")


def score(counted: DataFrame, candidates: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score``: each candidate at its lowest-scoring cut, the first of equals."""
    words = F.split("phrase", " ")
    cuts = candidates.select(
        "lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("k")
    ).select("lang", "phrase", "a", "k", _part(words, F.lit(1), F.col("k")).alias("left"),
             _part(words, F.col("k") + 1, F.size(words) - F.col("k")).alias("right"))
    for side, count in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counted.select("lang", F.col("phrase").alias(side), F.col("f").alias(count)), ["lang", side])
    exact = F.expr("cast(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + r) as long)")
    scored = cuts.withColumn("score", exact)
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    best = scored.groupBy("lang", "phrase", "a").agg(lowest)
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def maximal(candidates: DataFrame, percent: int) -> DataFrame:
    """Candidates that lie in no longer candidate with at least ``percent`` of their count."""
    words = F.split("phrase", " ")
    longer = candidates.withColumn("size", F.size(words)).filter("size > 2")
    inside = longer.select(
        "lang", "phrase", "a", F.explode(F.expr("sequence(2, size - 1)")).alias("length"), "size"
    ).select("lang", "phrase", "a", "length", F.explode(F.expr("sequence(1, size - length + 1)")).alias("begin"))
    parts = inside.select("lang", _part(words, F.col("begin"), F.col("length")).alias("phrase"), F.col("a").alias("over"))
    highest = parts.groupBy("lang", "phrase").agg(F.max("over").alias("over"))
    covered = 100 * F.col("over").cast("decimal(20,0)") >= percent * F.col("a").cast("decimal(20,0)")
    joined = candidates.join(highest, ["lang", "phrase"], "left")
    return joined.filter(F.col("over").isNull() | ~covered).drop("over")


def collocations(
    docs: DataFrame, at_least: int = 30, percent: int = 80, top: int = 2000, limits: Limits = Limits()
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of two to four words of each language.

    Texts are read whole, A-Z as small letters, cut at ``.,;:!?`` and line ends into pieces and at spaces and
    tabs into words; a phrase stays inside a piece. A null text is empty and a null language ``und``. Repeated
    rows count as often as they come; equal scores go by count and phrase; a table without a frequent phrase gives
    an empty result. Other columns are not read. A text of any length is counted in slices, phrases across them
    included. A frequent phrase costs its partition a row for each run that holds it, not for each occurrence.
    """
    texts = docs.select("text", F.coalesce("lang", F.lit(UNKNOWN_LANGUAGE)).alias("lang"))
    words = materialise(_count(texts, (1,), limits), "words")
    frequent = words.filter(F.col("f") >= at_least)
    pairs = materialise(_count(texts, (2,), limits, _filter(frequent, limits.filter_bits)).filter(F.col("f") >= at_least), "pairs")
    longer = materialise(_count(texts, (3, LONGEST), limits, _filter(pairs, limits.filter_bits)).filter(F.col("f") >= at_least), "longer")
    counted = frequent.unionByName(pairs).unionByName(longer)
    candidates = pairs.unionByName(longer).withColumnRenamed("f", "a")
    kept = maximal(candidates, percent)
    scored = score(counted, kept)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
