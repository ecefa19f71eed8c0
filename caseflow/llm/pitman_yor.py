"""A hierarchical Pitman-Yor model of words, seated by Gibbs sampling over the whole corpus.

Every word is drawn in the restaurant of the word before it. A customer opens a table of its own by a draw
from the parent, which all contexts share: there a word has a customer for each of its tables below. The
parent's parent is uniform over the words of the training texts and one for all others. Words are shared out
by hash, each with all its contexts, so a word's customers, tables and parent are at one place. A very frequent
word is spread over all places by its contexts.

Every context word has a restaurant of its own. What a restaurant sums over all words reaches the places in one
of two ways: for the most frequent words, with the customers of the spread words in the parent, as a vector of
fixed length; for all others by a shuffle, in which a place asks the owners of its contexts.

A round seats all customers of every place anew. A seating is never stored: a place replays its rounds from its
seed and the sums of earlier rounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.llm.blocks import SUMS, SUMS_ARROW, batches, chunk_numbers, document_sums, narrow, pack, runs, unpack
from caseflow.llm.common import map_arrow, materialise, worker_cache
from caseflow.llm.seating import Seating

# The word that ends every text; no word of a text holds a space.
END = b" end"


class Settings(NamedTuple):
    """Restaurants, and the sampler. The sums of ``contexts`` words travel as a vector, those of all others by a
    shuffle. With ``endings``, words outside the vector share restaurants by their last bytes instead."""

    contexts: int = 1 << 17
    endings: int = 0
    ending_bytes: int = 3
    discount: float = 0.8
    strength: float = 1.0
    parent_discount: float = 0.6
    parent_strength: float = 10.0
    rounds: int = 2  # each ends with an exchange of the vector
    sweeps: int = 1  # how often all customers of a large dish are seated anew in a round
    burn_in: int = 0  # rounds before the first that counts
    chunk_words: int = 600_000

    @property
    def restaurants(self) -> int:
        """Those of the vector: one for the first word of a text, the endings, the words."""
        return 1 + self.endings + self.contexts


class Known(NamedTuple):
    """What every task knows of the training words: sizes bounded by the settings and the number of buckets."""

    words: int
    tokens: int
    contexts: np.ndarray  # hashes of the words in the vector of restaurants, ascending
    hot: np.ndarray  # hashes of the words that are spread, ascending
    hot_counts: np.ndarray


class Words(NamedTuple):
    """The different words of a chunk by their place: hashes, and the restaurants that they lead to, places in the vector
    or a word's own place behind it."""

    hashes: np.ndarray
    restaurants: np.ndarray


def word_hash(word: bytes) -> int:
    """Words are told apart by 64 bits."""
    return xxhash.xxh64_intdigest(word, 42)


def among(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key in ``sorted_keys``, and whether it is there."""
    place = np.minimum(np.searchsorted(sorted_keys, keys), max(0, len(sorted_keys) - 1))
    return place, (sorted_keys[place] == keys if len(sorted_keys) else np.zeros(len(keys), bool))


def _words(names: list[bytes], settings: Settings, contexts: np.ndarray) -> Words:
    hashes = np.fromiter(map(word_hash, names), np.uint64, len(names))
    if settings.endings:
        rest = 1 + np.array([xxhash.xxh64_intdigest(w[-settings.ending_bytes :]) % settings.endings for w in names], np.int64)
    else:
        rest = settings.restaurants + np.arange(len(names))
    own, found = among(contexts, hashes)
    return Words(hashes, np.where(found, 1 + settings.endings + own, rest))


def distinct(keys: np.ndarray) -> np.ndarray:
    """The different ones of many whole numbers, ascending; a sort is much faster here than numpy's table of hashes."""
    ordered = np.sort(keys)
    return ordered[runs(ordered)]


class Chunk(NamedTuple):
    """Documents of a task: ``names`` are their different words, ``ids`` the places there of all their tokens, ends
    included, and ``counts`` how many each document has."""

    names: list[bytes]
    ids: np.ndarray
    counts: np.ndarray
    doc_ids: list[int | None]
    held_out: np.ndarray


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after another, and how many each text has. Null counts as empty."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words = lists.flatten()
    whole = pc.greater(pc.binary_length(words), 0)  # white space at either end of a text splits off an empty string
    counts = np.bincount(pc.list_parent_indices(lists).filter(whole).to_numpy(), minlength=len(lists))
    return words.filter(whole).cast(pa.binary()), counts.astype(np.int64)


def _chunk(held: list[tuple[pa.Array, np.ndarray, list, list]]) -> Chunk:
    """The words of a chunk are told apart by a table of its own, which is small enough to be fast."""
    coded = pa.chunked_array([words for words, *_ in held], pa.binary()).dictionary_encode().unify_dictionaries().chunks
    names = coded[0].dictionary.to_pylist() if coded else []
    counts = np.concatenate([n for _, n, _, _ in held]) + 1
    ends = np.cumsum(counts) - 1
    within = np.ones(int(counts.sum()), bool)
    within[ends] = False
    ids = np.full(len(within), len(names), np.int64)
    ids[within] = np.concatenate([np.zeros(0, np.int64), *(part.indices.to_numpy() for part in coded)])
    flags = [out for *_, held_out in held for out in held_out]
    return Chunk([*names, END], ids, counts, [i for _, _, doc_ids, _ in held for i in doc_ids], np.array(flags, bool))


def _chunks(given: Iterator[pa.RecordBatch], limit: int) -> Iterator[Chunk]:
    held: list[tuple[pa.Array, np.ndarray, list, list]] = []
    size = 0
    for batch in given:
        words, counts = _split(batch.column("text"))
        doc_ids, held_out = (batch.column(name).to_pylist() for name in ("doc_id", "held_out"))
        ends = np.concatenate([[0], np.cumsum(counts)]).tolist()
        begin = 0

        def hold(end: int) -> None:
            nonlocal begin
            if end > begin:
                some = words.slice(ends[begin], ends[end] - ends[begin])
                held.append((some, counts[begin:end], doc_ids[begin:end], held_out[begin:end]))
            begin = end

        for at, found in enumerate(counts.tolist()):
            if size and size + found > 2 * limit:  # a text of very many words makes a chunk of its own
                hold(at)
                yield _chunk(held)
                held, size = [], 0
            size += found + 1
            if size >= limit:
                hold(at + 1)
                yield _chunk(held)
                held, size = [], 0
        hold(len(counts))
    if held:
        yield _chunk(held)


def _word_counts(settings: Settings):
    """``w, n``: training tokens of every chunk by word hash."""

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(given, 4 * settings.chunk_words):
            learned = chunk.ids[np.repeat(~chunk.held_out, chunk.counts)]
            counts = np.bincount(learned, minlength=len(chunk.names))
            seen = np.flatnonzero(counts)
            hashes = np.fromiter((word_hash(chunk.names[i]) for i in seen.tolist()), np.uint64, len(seen)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(counts[seen])], names=["w", "n"])

    return run


def _bucket_of(hashes: np.ndarray, contexts: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    """A word's bucket; that of a hot word depends on the context as well."""
    spread = among(hot, hashes)[1]
    mixed = hashes + spread * (contexts + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def _owners_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return _bucket_of(hashes, np.zeros(len(hashes), np.uint64), np.zeros(0, np.uint64), buckets)


_DOCUMENT = "doc_id long, held_out boolean, n_tokens long"
_MAPPED = f"bucket int, chunk long, at int, pairs binary, entries binary, {_DOCUMENT}"
_BLOCKS = "array<struct<chunk: bigint, place: binary, entries: binary>>"
# ``key``: the bucket, owner or slice that a message goes to; ``other``: the one it comes from.
_MESSAGE = "kind int, key int, other int, round int, body binary"
_GATHERED = f"{_MESSAGE}, chunk long, at int, pairs binary, apart binary, blocks {_BLOCKS}, {_DOCUMENT}"

_DOCUMENT_ARROW = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64())]
_MAPPED_ARROW = pa.schema(
    [("bucket", pa.int32()), ("chunk", pa.int64()), ("at", pa.int32()), ("pairs", pa.binary()), ("entries", pa.binary()),
     *_DOCUMENT_ARROW]
)
_BLOCK_ARROW = pa.struct([("chunk", pa.int64()), ("place", pa.binary()), ("entries", pa.binary())])
_MESSAGE_ARROW = pa.schema([*((name, pa.int32()) for name in ("kind", "key", "other", "round")), ("body", pa.binary())])
_GATHERED_ARROW = pa.schema(
    [*_MESSAGE_ARROW, ("chunk", pa.int64()), ("at", pa.int32()), ("pairs", pa.binary()),
     ("apart", pa.binary()), ("blocks", pa.list_(_BLOCK_ARROW)), *_DOCUMENT_ARROW]
)
# A document; all pairs of a bucket with their blocks; its pairs of several tokens, whose tables can change; sums over
# contexts; the hashes of its contexts outside the vector, those in changing pairs and all; what their customers are more
# than their tables; the customers of contexts by owner; the answer of an owner.
DOCUMENT, WHOLE, CHANGING, SUM, ASKS, ASKS_ALL, LACK, SIZE, ANSWER = range(9)


def _pair_blocks(chunk: Chunk, words: Words, vector: int, hot: np.ndarray, buckets: int) -> Iterator[dict]:
    """Blocks of a chunk by bucket: ``pairs`` are its words, each with its contexts and their training tokens,
    ``entries`` the pairs of every document."""
    hashes, restaurants = words
    context = np.empty(len(chunk.ids), np.int64)
    context[1:] = restaurants[chunk.ids[:-1]]
    context[np.cumsum(chunk.counts) - chunk.counts] = 0
    doc = np.repeat(np.arange(len(chunk.counts)), chunk.counts)
    doc_bits = len(chunk.counts).bit_length()
    bits = (vector + len(hashes)).bit_length()
    mask = (1 << bits) - 1
    key = (((chunk.ids << bits) | context) << doc_bits) | doc
    key.sort()
    begins = runs(key)
    n = np.diff(np.append(begins, len(key)))
    key = key[begins]
    codes, doc = key >> doc_bits, key & ((1 << doc_bits) - 1)
    begins = runs(codes)
    pairs = codes[begins]
    context = pairs & mask
    names = context.astype(np.uint64)
    apart = context >= vector
    names[apart] = hashes[context[apart] - vector]
    bucket = _bucket_of(hashes[pairs >> bits], names, hot, buckets)
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(pairs), np.int64)
    rank[order] = np.arange(len(pairs))
    documents = np.diff(np.append(begins, len(codes)))
    place = np.repeat(rank, documents)
    by_bucket = np.argsort(np.repeat(bucket, documents) * len(chunk.counts) + doc, kind="stable")
    pairs, bucket, context = pairs[order], bucket[order], context[order]
    place, doc, n = place[by_bucket], doc[by_bucket], n[by_bucket]
    learned = np.bincount(place, weights=n * ~chunk.held_out[doc], minlength=len(pairs)).astype(np.int64)
    ends = np.arange(buckets + 1)
    of_pairs, of_entries = np.searchsorted(bucket, ends), np.searchsorted(bucket[place], ends)
    for number in np.flatnonzero(np.diff(of_pairs)).tolist():
        own = slice(of_pairs[number], of_pairs[number + 1])
        entry = slice(of_entries[number], of_entries[number + 1])
        word, codes = pairs[own] >> bits, context[own]
        rest, code = np.unique(codes[codes >= vector], return_inverse=True)
        codes[codes >= vector] = vector + code
        first, docs = runs(word), runs(doc[entry])
        yield {
            "bucket": number,
            "pairs": pack(
                hashes[word[first]], narrow(np.diff(np.append(first, len(word)))), narrow(codes), narrow(learned[own]),
                hashes[rest - vector],
            ),
            "entries": pack(
                narrow(doc[entry][docs]), narrow(np.diff(np.append(docs, entry.stop - entry.start))),
                narrow(place[entry] - own.start), narrow(n[entry]),
            ),
        }


def _pairing(settings: Settings, known, buckets: int):
    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("words", "none", dict)  # what other operators keep in the process goes
        facts: Known = known.value
        for name, chunk in zip(chunk_numbers(), _chunks(given, settings.chunk_words)):
            words = _words(chunk.names, settings, facts.contexts)
            documents = zip(chunk.doc_ids, chunk.held_out.tolist(), chunk.counts.tolist(), strict=True)
            rows = [
                {"bucket": (name + at) % buckets, "chunk": name, "at": at, "doc_id": i, "held_out": out, "n_tokens": n}
                for at, (i, out, n) in enumerate(documents)
            ]
            rows += [row | {"chunk": name} for row in _pair_blocks(chunk, words, settings.restaurants, facts.hot, buckets)]
            yield from batches(rows, _MAPPED_ARROW)

    return run


def _by_owner(kind: int, bucket: int, owners: np.ndarray, values: np.ndarray, number: int = 0) -> Iterator[dict]:
    """A message to each of ``owners``, which ascend."""
    begins = runs(owners)
    for owner, part in zip(owners[begins].tolist(), np.split(values, begins[1:]), strict=True):
        yield {"kind": kind, "key": owner, "other": bucket, "round": number, "body": pack(part)}


def _lacks(place: Place, number: int, buckets: int) -> Iterator[dict]:
    """Customers less tables of the contexts outside the vector, for those who own them."""
    if len(place.apart):
        behind = place.context >= place.settings.restaurants
        codes = place.context[behind] - place.settings.restaurants
        lack = np.bincount(codes, weights=(place.learned - place.tables)[behind], minlength=len(place.apart))
        yield from _by_owner(LACK, place.bucket, _owners_of(place.apart, buckets), narrow(lack.astype(np.int64)), number)


def _slices(sums: np.ndarray, number: int) -> Iterator[dict]:
    for i, part in enumerate(np.array_split(sums, _SLICES)):
        yield {"kind": SUM, "key": i, "round": number, "body": pack(part)}


def _merged(held: list[dict], vector: int, buckets: int) -> tuple[list[np.ndarray], list[dict]]:
    """The pairs of all blocks of a bucket: hashes of the words, contexts of each, contexts, training tokens, hashes of the
    contexts outside the vector by owner; and the blocks with the places of their pairs among these."""
    parts = [unpack(row.pop("pairs")) for row in held]
    hashes = distinct(np.concatenate([p[0] for p in parts]))
    apart = distinct(np.concatenate([p[4] for p in parts]))
    order = np.argsort(_owners_of(apart, buckets), kind="stable")
    rank = np.empty(len(apart), np.int64)
    rank[order] = np.arange(len(apart))
    bits = (vector + len(apart)).bit_length()
    codes = []
    for own, sizes, context, _, rest in parts:
        word = np.repeat(np.searchsorted(hashes, own), sizes)
        context = context.astype(np.int64)
        behind = context >= vector
        context[behind] = vector + rank[np.searchsorted(apart, rest)][context[behind] - vector]
        codes.append((word << bits) | context)
    pairs = distinct(np.concatenate(codes))
    learned = np.zeros(len(pairs), np.int64)
    blocks = []
    for row, code, (_, _, _, counts, _) in zip(held, codes, parts, strict=True):
        place = np.searchsorted(pairs, code)
        learned[place] += counts
        blocks.append({"chunk": row["chunk"], "place": pack(narrow(place)), "entries": row["entries"]})
    sizes = np.bincount(pairs >> bits, minlength=len(hashes))
    return [hashes, sizes, pairs & ((1 << bits) - 1), learned, apart[order]], blocks


def _changing(hashes: np.ndarray, sizes: np.ndarray, context: np.ndarray, learned: np.ndarray, apart: np.ndarray, vector: int) -> list[np.ndarray]:
    """Pairs of several training tokens in the same form, words without any training token left out, and how many other
    pairs every word has learned."""
    word = np.repeat(np.arange(len(hashes)), sizes)
    several = learned > 1
    single = np.bincount(word[learned == 1], minlength=len(hashes))
    sizes = np.bincount(word[several], minlength=len(hashes))
    known = (single > 0) | (sizes > 0)
    context = context[several]
    behind = context >= vector
    rest = distinct(context[behind])
    context[behind] = vector + np.searchsorted(rest, context[behind])
    return [hashes[known], sizes[known], context, learned[several], apart[rest - vector], single[known]]


def _body(arrays: list[np.ndarray]) -> bytes:
    hashes, sizes, context, learned, apart, *single = arrays
    return pack(hashes, narrow(sizes), narrow(context), narrow(learned), apart, *map(narrow, single))


def _gathering(settings: Settings, known, buckets: int):
    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All blocks of a bucket as one row with the pairs they share, and what it has to tell others; documents go on
        as they are."""
        worker_cache("words", "none", dict)
        held: list[dict] = []
        for batch in given:
            is_block = pc.is_valid(batch.column("pairs"))
            held += batch.filter(is_block).select(["bucket", "chunk", "pairs", "entries"]).to_pylist()
            documents = batch.filter(pc.invert(is_block))
            if documents.num_rows:
                columns = {f.name: pa.nulls(documents.num_rows, f.type) for f in _GATHERED_ARROW}
                columns |= {name: documents.column(name) for name in documents.schema.names if name in columns}
                columns |= {"kind": pa.array(np.full(documents.num_rows, DOCUMENT, np.int32)), "pairs": columns["pairs"]}
                yield pa.RecordBatch.from_arrays(list(columns.values()), schema=_GATHERED_ARROW)
        if not held:
            return
        bucket, vector = held[0]["bucket"], settings.restaurants
        whole, blocks = _merged(held, vector, buckets)
        del held
        apart = whole[4]
        pairs = _body([*whole[:4], apart[:0]])
        row = {"kind": WHOLE, "key": bucket, "pairs": pairs, "apart": pack(apart), "blocks": blocks}
        yield pa.RecordBatch.from_pylist([row], _GATHERED_ARROW)
        del blocks, row
        few = _changing(*whole, vector)
        body = _body(few)
        rows = [{"kind": CHANGING, "key": bucket, "body": body}]
        if len(few[4]):
            rows += _by_owner(ASKS, bucket, _owners_of(few[4], buckets), few[4])
        rows += _lacks(Place(bucket, body, known.value, settings), 0, buckets)
        in_vector = np.where(whole[2] < vector, whole[2], vector)
        single = np.bincount(in_vector, weights=whole[3] == 1, minlength=vector + 1)[:vector].astype(np.int64)
        rows += _slices(np.concatenate([single, Place(bucket, pairs, known.value, settings).sums()]), 0)
        yield from batches(rows, _GATHERED_ARROW)

    return run


class Totals(NamedTuple):
    """Sums over all buckets after a round: customers and tables by restaurant, hot words' customers in the
    parent and their tables there, customers and tables of the parent."""

    customers: np.ndarray
    tables: np.ndarray
    hot: np.ndarray
    hot_tables: np.ndarray
    parent_customers: int
    parent_tables: int


class Place:
    """The pairs of a bucket and their seating after the rounds replayed so far."""

    def __init__(self, bucket: int, packed: bytes, known: Known, settings: Settings) -> None:
        hashes, sizes, context, learned, *rest = unpack(packed)
        self.bucket, self.known, self.settings = bucket, known, settings
        self.context = context.astype(np.int64)
        # hashes of the contexts outside the vector; pairs of one training token that every word has beside these
        self.apart, self.single = [*rest, *[np.zeros(0, np.uint64), np.zeros(len(hashes), np.int64)][len(rest) :]]
        self.answers = [np.zeros(len(self.apart), np.int64)]  # their customers, and their tables before each round
        self.rounds = 0
        self.word = np.repeat(np.arange(len(hashes)), sizes)
        self.learned = learned.astype(np.int64)
        self.hot_place, self.is_hot = among(known.hot, hashes)
        counts = np.bincount(self.word, weights=self.learned, minlength=len(hashes)).astype(np.int64) + self.single
        hot_counts = known.hot_counts[self.hot_place] if len(known.hot) else 0
        self.counts = np.where(self.is_hot, hot_counts, counts)
        self.tables = (self.learned > 0).astype(np.int64)
        self.parent_tables = (self.counts > 0).astype(np.int64)
        self._several = np.flatnonzero(self.learned > 1)
        self._dishes: Seating | None = None
        self._rng = np.random.default_rng([bucket, 12])

    def parent_customers(self, totals: Totals | None) -> np.ndarray:
        """Of every word: its tables below, in all buckets."""
        own = np.bincount(self.word, weights=self.tables, minlength=len(self.counts)).astype(np.int64) + self.single
        return np.where(self.is_hot, totals.hot[self.hot_place], own) if totals and len(self.known.hot) else own

    def parent_probability(self, totals: Totals) -> np.ndarray:
        s = self.settings
        customers = self.parent_customers(totals)
        tables = np.where(self.is_hot, totals.hot_tables[self.hot_place], self.parent_tables) if len(self.known.hot) else self.parent_tables
        own = customers - s.parent_discount * tables + base_weight(self.known, totals, s)
        return own / (s.parent_strength + totals.parent_customers)

    def open_tables(self, totals: Totals) -> np.ndarray:
        """Tables in the restaurant of every pair, in all buckets."""
        if not len(self.answers[0]):
            return totals.tables[self.context]
        return np.concatenate([totals.tables, self.answers[1 + self.rounds]])[self.context]

    def round(self, totals: Totals) -> None:
        """A new seating given the sums of the round before."""
        s = self.settings
        chosen = self._several
        others = self.open_tables(totals)[chosen] - self.tables[chosen]
        drawn = self.parent_probability(totals)[self.word[chosen]]
        weight, rise = (s.strength + s.discount * others) * drawn, s.discount * drawn
        if self._dishes is None:
            self._dishes = Seating(self.learned[chosen], s.discount, weight, self._rng, s.sweeps, rise)
        else:
            self._dishes.sweep(weight, self._rng, rise)
        self.tables[chosen] = self._dishes.tables()
        self.parent_tables = parent_seating(self.parent_customers(None) * ~self.is_hot, self.known, totals, s, self._rng)
        self.rounds += 1

    def sums(self) -> np.ndarray:
        """Customers and tables by restaurant, hot customers, and the parent's customers and tables."""
        n = self.settings.restaurants
        parent = self.parent_customers(None)
        hot = np.zeros(len(self.known.hot), np.int64)
        hot[self.hot_place[self.is_hot]] = parent[self.is_hot]
        place = np.minimum(self.context, n)
        parts = [np.bincount(place, weights=x, minlength=n + 1)[:n].astype(np.int64) for x in (self.learned, self.tables)]
        ends = [self.tables.sum() + self.single.sum(), (self.parent_tables * ~self.is_hot).sum()]
        return np.concatenate([*parts, hot, np.array(ends, np.int64)])

    def predictive(self, totals: Totals) -> np.ndarray:
        """Probability of every pair's word in its context, under this seating."""
        s = self.settings
        opens = s.strength + s.discount * self.open_tables(totals)
        drawn = self.learned - s.discount * self.tables + opens * self.parent_probability(totals)[self.word]
        customers = np.concatenate([totals.customers, self.answers[0]])[self.context]
        return drawn / (s.strength + customers)


def base_weight(known: Known, totals: Totals, s: Settings) -> float:
    """What draws a customer of the parent to a new table, for any one word: the base is uniform over the
    training words and one word for all others."""
    return (s.parent_strength + s.parent_discount * totals.parent_tables) / (known.words + 1)


def parent_seating(customers: np.ndarray, known: Known, totals: Totals, s: Settings, rng) -> np.ndarray:
    present = np.flatnonzero(customers)
    weight = np.full(len(present), base_weight(known, totals, s))
    seated = Seating(customers[present], s.parent_discount, weight, rng, s.sweeps)
    tables = np.zeros(len(customers), np.int64)
    tables[present] = seated.tables()
    return tables


def _replayed(row: dict, facts: Known, history: list[Totals], settings: Settings) -> Iterator[Place]:
    """The place of a bucket, before the first round and after each."""
    place = Place(row["bucket"], row["pairs"], facts, settings)
    if row.get("answers"):
        place.answers = row["answers"]
    yield place
    for totals in history:
        place.round(totals)
        yield place


_SLICES = 16


def _with_answers(given: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The place of each bucket in a partition with the answers to what it asked, in the order in which it asked."""
    places: list[dict] = []
    answers: dict[int, list[tuple[int, bytes]]] = {}
    for batch in given:
        for row in batch.to_pylist():
            if row["kind"] == ANSWER:
                answers.setdefault(row["key"], []).append((row["other"], row["body"]))
            else:
                places.append(row)
    for row in places:
        parts = [unpack(body) for _, body in sorted(answers.pop(row["key"], []))]
        row["bucket"], row["pairs"] = row["key"], row["pairs"] or row["body"]
        row["answers"] = [np.concatenate(column).astype(np.int64) for column in zip(*parts, strict=True)]
        yield row


def _round(settings: Settings, known, history, buckets: int):
    """``SUM`` and ``LACK`` of every bucket after the next round."""

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("words", "none", dict)
        number = len(history.value)
        for row in _with_answers(given):
            *_, place = _replayed(row, known.value, history.value, settings)
            rows = [*_slices(place.sums()[settings.restaurants :], number), *_lacks(place, number, buckets)]
            yield from batches(rows, _MESSAGE_ARROW)

    return run


def _sizes(known, buckets: int):
    """Customers of the contexts outside the vector, for their owners: every training token but the last of a text is
    the context of one, and the end of a text is none."""

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            hashes = batch.column("w").to_numpy().view(np.uint64)
            apart = ~among(known.value.contexts, hashes)[1]
            hashes, n = hashes[apart], batch.column("n").to_numpy()[apart]
            owners = _owners_of(hashes, buckets)
            order = np.argsort(owners, kind="stable")
            owners, hashes, n = owners[order], hashes[order], n[order]
            ends = np.append(runs(owners), len(owners))
            rows = [
                {"kind": SIZE, "key": int(owners[a]), "body": pack(hashes[a:b], narrow(n[a:b]))}
                for a, b in zip(ends[:-1], ends[1:], strict=True)
            ]
            yield from batches(rows, _MESSAGE_ARROW)

    return run


def _asks_all(buckets: int):
    """What the places ask for all their pairs."""

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            for row in batch.to_pylist():
                apart = unpack(row["apart"])[0]
                if len(apart):
                    yield from batches(list(_by_owner(ASKS_ALL, row["key"], _owners_of(apart, buckets), apart)), _MESSAGE_ARROW)

    return run


def _answer(kind: int, rounds: int):
    """To each message of ``kind``: the customers of its contexts, and their tables at the beginning of each of ``rounds``."""

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in given for row in batch.to_pylist()]
        sizes = [unpack(r["body"]) for r in rows if r["kind"] == SIZE]
        if not sizes:
            sizes = [[np.zeros(0, np.uint64), np.zeros(0, np.int64)]]
        hashes, customers = (np.concatenate(column) for column in zip(*sizes, strict=True))
        order = np.argsort(hashes)
        hashes, customers = hashes[order], customers[order].astype(np.int64)
        asked = {r["other"]: among(hashes, unpack(r["body"])[0])[0] for r in rows if r["kind"] == ASKS}
        tables = [customers.copy() for _ in range(rounds)]
        for r in rows:
            if r["kind"] == LACK:
                tables[r["round"]][asked[r["other"]]] -= unpack(r["body"])[0]
        for r in rows:
            if r["kind"] == kind:
                place, found = among(hashes, unpack(r["body"])[0])
                columns = [narrow(x[place] * found) if len(x) else np.zeros(len(place), np.uint8) for x in (customers, *tables)]
                answer = {"kind": ANSWER, "key": r["other"], "other": r["key"], "body": pack(*columns)}
                yield pa.RecordBatch.from_pylist([answer], _MESSAGE_ARROW)

    return run


def _add_up(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in given:
        for row in batch.to_pylist():
            part = unpack(row["body"])[0]
            sums[row["key"]] = sums[row["key"]] + part if row["key"] in sums else part
    schema = pa.schema([("key", pa.int32()), ("body", pa.binary())])
    yield from batches([{"key": i, "body": pack(part)} for i, part in sums.items()], schema)


def _added(messages: DataFrame, length: int) -> np.ndarray:
    """The sum of a vector over all buckets."""
    sums = messages.filter(F.col("kind") == SUM).select("key", "body").repartition(_SLICES, "key")
    parts = {r["key"]: unpack(bytes(r["body"]))[0] for r in map_arrow(sums, _add_up, "key int, body binary").toLocalIterator()}
    return np.concatenate([parts[i] for i in range(_SLICES)]) if parts else np.zeros(length, np.int64)


def _scores(settings: Settings, known, history):
    """For every document of a block its tokens seen in training, and both log10 probabilities."""

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("words", "none", dict)
        facts, totals = known.value, history.value
        for row in _with_answers(given):
            samples = []
            for number, place in enumerate(_replayed(row, facts, totals[:-1], settings)):
                if number > settings.burn_in or number == len(totals) - 1:
                    samples.append(place.predictive(totals[number]))
            score = np.log10(np.mean(samples, axis=0))
            counts = place.counts[place.word]
            base = np.log10((counts + 1) / (facts.tokens + facts.words + 1))
            for block in row["blocks"]:
                own = unpack(block["place"])[0]
                docs, sizes, rank, n = unpack(block["entries"])
                pair = own[rank]
                starts = np.cumsum(sizes.astype(np.int64)) - sizes
                sums = (np.add.reduceat(n * x[pair], starts) for x in ((counts > 0).astype(np.int64), base, score))
                yield from batches([{"chunk": block["chunk"], "sums": pack(docs, *sums)}], SUMS_ARROW)

    return run


def _known(words: DataFrame, settings: Settings, buckets: int) -> Known:
    """Totals, the words in the vector of restaurants and the hot ones, from the table of training words."""
    facts = words.agg(F.count("*").alias("words"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()
    level = F.floor(F.log2("n")).cast("int").alias("level")
    by_level = {r["level"]: r["count"] for r in words.groupBy(level).count().toLocalIterator()}
    least, chosen = 64, 0
    for number in sorted(by_level, reverse=True):
        if chosen + by_level[number] > settings.contexts:
            break
        least, chosen = number, chosen + by_level[number]
    contexts = [r["w"] for r in words.filter(level >= least).select("w").toLocalIterator()] if chosen else []
    hot = words.filter(F.col("n") * (2 * buckets) >= facts["tokens"]).filter("n > 1000").select("w", "n")
    held = sorted((np.int64(r["w"]).view(np.uint64), r["n"]) for r in hot.toLocalIterator())
    return Known(
        facts["words"], int(facts["tokens"]), np.sort(np.array(contexts, np.int64).view(np.uint64)),
        np.array([w for w, _ in held], np.uint64), np.array([n for _, n in held], np.int64),
    )


def score_documents(docs: DataFrame, buckets: int, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each row of ``docs``
    (doc_id, text, held_out): the model learns from all rows that are not held out and scores all.

    Texts are read whole, A-Z as small letters, split at ASCII white space, and end with a token of their own, so a
    null or empty text has one token. ``base_score`` is the log10 probability under smoothed word counts, ``score``
    that under the probabilities averaged over the rounds after the burn-in. Rows keep apart whatever their doc_id
    (null, repeated), repeated texts count as often as they come, a null ``held_out`` is false, other columns are not
    read. Without any training row every token has probability 1. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce("held_out", F.lit(False)).alias("held_out"))
    counts = map_arrow(given, _word_counts(settings), "w long, n long")
    words = materialise(counts.groupBy("w").agg(F.sum("n").alias("n")), "train-words", tidy=True)
    facts = _known(words, settings, buckets)
    known = spark.sparkContext.broadcast(facts)

    mapped = map_arrow(given, _pairing(settings, known, buckets), _MAPPED)
    dealt = mapped.repartitionById(buckets, F.col("bucket"))
    held = materialise(map_arrow(dealt, _gathering(settings, known, buckets), _GATHERED), "word-pairs", tidy=True)

    names = [f.name for f in _MESSAGE_ARROW]
    sizes = map_arrow(words, _sizes(known, buckets), _MESSAGE)
    told = [held.select(*names)]

    def with_answers(places: DataFrame, kind: int, asks: list[DataFrame]) -> DataFrame:
        """The places, each in a partition with the answers to its messages of ``kind``."""
        wanted = F.col("kind").isin(ASKS, LACK)
        asked = reduce(DataFrame.unionByName, [sizes, *asks, *[m.filter(wanted) for m in told]])
        answers = map_arrow(asked.repartitionById(buckets, F.col("key")), _answer(kind, len(told)), _MESSAGE)
        answers = materialise(answers, "answers", tidy=True)
        return places.unionByName(answers, allowMissingColumns=True).repartitionById(buckets, F.col("key"))

    n, hot = settings.restaurants, len(facts.hot)
    single, customers, *first = np.split(_added(told[0], 3 * n + hot + 2), [n, 2 * n])
    changing = held.filter(F.col("kind") == CHANGING).select(*names, F.lit(None).cast("binary").alias("pairs"))
    history: list[Totals] = []
    rng = np.random.default_rng(13)
    for number in range(settings.rounds + 1):
        if number:
            each = map_arrow(with_answers(changing, ASKS, []), _round(settings, known, spark.sparkContext.broadcast(history), buckets), _MESSAGE)
            told.append(materialise(each, f"round-{number}", tidy=True))
            sums = _added(told[-1], n + hot + 2)
            sums[:n] += single
        else:
            sums = first[0]
        tables, hot_customers, (all_customers, all_tables) = np.split(sums, [n, n + hot])
        before = history[-1] if history else None
        hot_tables = parent_seating(hot_customers, facts, before, settings, rng) if before and hot else (hot_customers > 0).astype(np.int64)
        history.append(Totals(customers, tables, hot_customers, hot_tables, int(all_customers), int(all_tables + hot_tables.sum())))

    whole = held.filter(F.col("kind") == WHOLE).select(*names, "pairs", "blocks")
    asks = map_arrow(held.filter(F.col("kind") == WHOLE).select("key", "apart"), _asks_all(buckets), _MESSAGE)
    given = with_answers(whole, ASKS_ALL, [asks])
    scored = map_arrow(given, _scores(settings, known, spark.sparkContext.broadcast(history)), SUMS)
    summed = document_sums(scored, {"n_known": "long", "base_score": "double", "score": "double"})
    documents = held.filter(F.col("kind") == DOCUMENT).select("chunk", "at", "doc_id", "held_out", "n_tokens")
    return documents.join(summed, ["chunk", "at"]).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(facts.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
