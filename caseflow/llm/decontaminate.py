"""Benchmark passages in documents, by the q-gram lemma and banded alignment.

Texts are compared by their letters and digits, lower-cased; everything else is left out, so case,
spacing and punctuation do not matter. A passage is a window of WINDOW characters of a benchmark
item (or a whole shorter item) that aligns with some part of a document within ``budget`` edits.

By the lemma, a window of m characters within e edits of a document shares at least
m + 1 - q (e + 1) q-grams with it on neighbouring diagonals, e + 1 of them. Shared q-grams are counted
in diagonal bands of width 2 (e + 1) that overlap by half, so that any e + 1 neighbouring diagonals lie
in one band, and within every window of the item. Only windows that reach the count are aligned.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.llm.common import chunks, map_arrow, text_bytes, without_caches

Q = 8
WINDOW = 100
EDIT_SHARE = 0.08
# Benchmark characters compared in one pass over the documents; more take several passes.
BLOCK_CHARS = 4 << 20
# Text of a batch that is looked at together, in bytes, and alignments made together.
TEXT_AT_ONCE = 2 << 20
ALIGN_AT_ONCE = 4096
# Pairs of equal q-grams looked at together.
PAIRS = 1 << 19
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_DOC_GAP, _ITEM_GAP = 1, 2  # characters that match nothing on the other side
_FILTER_BITS = 22


@cache
def _folded() -> np.ndarray:
    """For each code point its lower-case code point if it is a letter or digit, else 0."""
    table = np.zeros(sys.maxunicode + 1, np.uint32)
    for point in range(sys.maxunicode + 1):
        char = chr(point)
        if unicodedata.category(char)[0] in "LN":
            lower = char.lower()
            table[point] = ord(lower) if len(lower) == 1 else point
    return table


def normalised(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Letters and digits of a text in lower case, and the position of each in the text."""
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le", "replace"), "<u4")
    folded = _folded()[points]
    (at,) = np.nonzero(folded)
    return folded[at], at


def _grams(chars: np.ndarray) -> np.ndarray:
    """A 64-bit value of the Q characters from each position on; Q is a power of two."""
    values, span, factor = chars.astype(np.uint64), 1, _MULTIPLIER
    while span < Q:
        values = values[:-span] * factor + values[span:] if len(values) > span else values[:0]
        with np.errstate(over="ignore"):
            factor = factor * factor
        span *= 2
    return values


def budget(length: int, share: float = EDIT_SHARE) -> int:
    """Edits allowed to a window; never so many that the lemma would promise no shared q-gram."""
    return max(0, min(int(share * length), length // Q - 1))


@dataclass
class Block:
    """Benchmark items laid end to end, with an index of their q-grams."""

    item_id: list
    chars: np.ndarray
    begin: np.ndarray  # of each item
    item_of: np.ndarray  # item of each position
    window: np.ndarray  # window length by item
    edits: np.ndarray
    needed: np.ndarray  # shared q-grams by item
    grams: np.ndarray  # distinct, sorted
    first: np.ndarray  # of each gram in ``places``; one more at the end
    places: np.ndarray
    short: dict[bytes, list]  # items of fewer than Q characters, by their characters


def build_block(items: list[tuple], window: int = WINDOW, share: float = EDIT_SHARE) -> Block:
    ids, parts, short = [], [], {}
    for item_id, text in items:
        chars, _ = normalised((text or "").encode())
        if len(chars) >= Q:
            ids.append(item_id)
            parts.append(chars)
        elif len(chars):
            short.setdefault(chars.tobytes(), []).append(item_id)
    sizes = np.array([len(p) for p in parts], np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    gap = np.array([_ITEM_GAP], np.uint32)
    chars = np.concatenate([x for p in parts for x in (p, gap)]) if parts else np.zeros(0, np.uint32)
    item_of = np.repeat(np.arange(len(parts)), sizes + 1)
    grams = _grams(chars)
    inside = np.arange(len(grams)) + Q <= (begin + sizes)[item_of[: len(grams)]] if parts else np.zeros(0, bool)
    (places,) = np.nonzero(inside)
    places = places[np.argsort(grams[places], kind="stable")]
    distinct, first = np.unique(grams[places], return_index=True)
    windows = np.minimum(sizes, window)
    edits = np.array([budget(int(w), share) for w in windows], np.int64)
    return Block(
        ids, chars, begin, item_of, windows, edits, windows + 1 - Q * (edits + 1), distinct,
        np.append(first, len(places)), places, short,
    )


def _filter_table(block: Block) -> np.ndarray:
    table = np.zeros(1 << _FILTER_BITS, bool)
    table[block.grams >> np.uint64(64 - _FILTER_BITS)] = True
    return table


def shared_grams(block: Block, table: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document positions whose q-gram stands in the block, and its number there."""
    grams = _grams(chars)
    (at,) = np.nonzero(table[grams >> np.uint64(64 - _FILTER_BITS)])
    gram = np.searchsorted(block.grams, grams[at])
    gram[gram == len(block.grams)] = 0
    same = block.grams[gram] == grams[at] if len(block.grams) else np.zeros(0, bool)
    return at[same], gram[same]


def slices(block: Block, at: np.ndarray, gram: np.ndarray) -> Iterator[slice]:
    """Cuts of the positions with about PAIRS pairs each. Neighbours overlap by what the q-grams of one window
    and band can span, so each lies in a cut whole; a cut is at least twice that long."""
    reach = int((block.window + 2 * (block.edits + 1)).max())
    pairs = np.cumsum(block.first[gram + 1] - block.first[gram])
    begin = 0
    while True:
        before = pairs[begin - 1] if begin else 0
        end = int(np.searchsorted(pairs, before + PAIRS, side="right"))
        end = max(end, int(np.searchsorted(at, at[begin] + 2 * reach)))
        yield slice(begin, end)
        if end >= len(at):
            return
        begin = max(begin + 1, int(np.searchsorted(at, at[end] - reach)))


def pairs(block: Block, at: np.ndarray, gram: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document position, item position) of equal q-grams, all of them, some at a time: beyond PAIRS the places
    of the items are cut as well, again so that the q-grams of every window lie in one part."""
    low, high = block.first[gram], block.first[gram + 1]
    if (high - low).sum() <= PAIRS:
        yield _pairs(block, at, low, high)
        return
    overlap = int(block.window.max())
    step = max(overlap, PAIRS // len(at))
    keys = np.repeat(np.arange(len(block.grams)), np.diff(block.first)) * len(block.chars) + block.places
    for begin in range(0, len(block.chars), step):
        end = min(begin + step + overlap, len(block.chars))
        low = np.searchsorted(keys, gram * len(block.chars) + begin)
        high = np.searchsorted(keys, gram * len(block.chars) + end)
        if (high > low).any():
            yield _pairs(block, at, low, high)


def _pairs(block: Block, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    count = high - low
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(at, count), block.places[np.repeat(low, count) + nth]


def candidates(block: Block, position: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Regions (item, first diagonal of the band, first and last window begin) that may hold a passage: runs
    of window begins of an item whose window has enough q-grams in the band."""
    found = []
    item = block.item_of[place]
    # the band width follows the budget, which is one for all items as long as the window
    for edits in np.unique(block.edits[item]):
        own = block.edits[item] == edits
        p, g = position[own], place[own]
        half = int(edits) + 1
        diagonal = p - g + len(block.chars)  # not negative
        for shift in (0, half):
            band = (diagonal + shift) // (2 * half)
            # most bands hold few q-grams: drop them before anything is sorted
            low = int(band.min())
            enough = np.bincount(band - low)[band - low] >= block.needed[item[own]]
            b, h = band[enough], g[enough]
            if not len(b):
                continue
            both = np.sort(b * len(block.chars) + h)
            new = np.append(True, np.diff(both) != 0)  # of equal hits the first reaches furthest
            b, h = np.divmod(both, len(block.chars))
            which = block.item_of[h]
            needed, window = block.needed[which], block.window[which]
            last = np.arange(len(h)) + needed - 1
            inside = last < len(h)
            last = np.minimum(last, len(h) - 1)
            ok = new & inside & (b[last] == b) & (which[last] == which) & (h[last] - h <= window - Q)
            (at,) = np.nonzero(ok)
            if not len(at):
                continue
            # windows that hold the grams at..last begin between these two places of the item
            item_end = block.begin + np.append(np.diff(block.begin), len(block.chars) - block.begin[-1]) - 1
            low_begin = np.maximum(h[last[at]] + Q - window[at], block.begin[which[at]])
            high_begin = np.minimum(h[at], (item_end[which] - window)[at])
            first_diagonal = b[at] * (2 * half) - shift - len(block.chars)
            found.append(np.stack([which[at], first_diagonal, low_begin, high_begin]))
    if not found:
        return np.zeros((4, 0), np.int64)
    rows = np.concatenate(found, axis=1)
    return _merged(rows[:, rows[2] <= rows[3]])


def _merged(regions: np.ndarray) -> np.ndarray:
    """Regions of one item and band that touch, as one."""
    if not regions.shape[1]:
        return regions
    item, diagonal, low, high = regions[:, np.lexsort((regions[2], regions[1], regions[0]))]
    other = np.append(True, (np.diff(item) != 0) | (np.diff(diagonal) != 0))
    base = np.cumsum(other) * (int(high.max()) + 2)
    reached = np.maximum.accumulate(base + high) - base
    (starts,) = np.nonzero(other | np.append(True, low[1:] > reached[:-1] + np.where(other[1:], 0, 1)))
    return np.stack([item[starts], diagonal[starts], low[starts], np.maximum.reduceat(high, starts)])


def align(
    block: Block, chars: np.ndarray, begins: np.ndarray, diagonals: np.ndarray, edits: int, window: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Banded alignments of item windows with the document, all of one length and budget at once.

    An alignment may begin and end anywhere in the document but stays on the diagonals of its band and
    ``edits`` to either side. Returns the fewest edits of each, and the begin and end of the aligned part:
    among several alignments with the fewest edits the one that begins first, then ends first.
    """
    width = 2 * (edits + 1) + 2 * edits
    far = window + width
    # column j of row i stands for document position begin + diagonal - edits + i + j
    base = begins + diagonals - edits
    padded = np.concatenate([np.full(far, _DOC_GAP, chars.dtype), chars, np.full(2 * far, _DOC_GAP, chars.dtype)])
    base = np.clip(base, -far, len(chars)) + far
    n = len(begins)
    columns = np.arange(width)
    # edits and begin in one number: an edit counts ``one``, the begin (a column) less than that
    one, never = width, window + 1
    big = one * never
    cost = np.broadcast_to(columns, (n, width)).astype(np.int64)
    gaps = np.append(0, np.cumsum(padded == _DOC_GAP))  # no alignment crosses from one document to another
    for i in range(window):
        text = padded[base[:, None] + i + columns]
        # same diagonal: same column
        step = cost + np.where(text == _DOC_GAP, big, np.where(text != block.chars[begins + i][:, None], one, 0))
        # an item character without a document character: from column j + 1 of the row above
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + one)
        # document characters without an item character: along the row
        crossed = gaps[base[:, None] + i + 1 + columns]
        along = columns * one + (crossed - crossed[:, :1]) * big
        cost = np.minimum.accumulate(step - along, axis=1) + along
        cost = np.where(cost >= big, big + cost % one, cost)
    end = cost.argmin(axis=1)
    rows = np.arange(n)
    zero = base - far
    least = cost[rows, end]
    return least // one, zero + least % one, zero + window + end


def passages(block: Block, table: np.ndarray, texts: list[bytes], best_only: bool = True) -> list[tuple]:
    """(text number, item_id, doc_start, doc_end, item_start, edits) for every text and item that share a
    passage; positions are code points of the text and characters of the normalised item, and among
    several windows the one with the fewest edits, then the first, is given, where it begins first in
    the text, then ends first. Every window of every region is aligned unless an exact one before it already
    decides, so neither the other texts nor
    their order matter. Without ``best_only`` any window may stand for a text and item: enough for a yes."""
    parts, places = [], []
    for text in texts:
        chars, at = normalised(text)
        parts.append(chars)
        places.append(at)
    out = []
    if block.short:
        for n, chars in enumerate(parts):
            for item_id in block.short.get(chars.tobytes(), ()):
                out.append((n, item_id, int(places[n][0]), int(places[n][-1]) + 1, 0, 0))
    if not len(block.grams):
        return out
    sizes = np.array([len(p) for p in parts], np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    gap = np.array([_DOC_GAP], np.uint32)
    chars = np.concatenate([x for p in parts for x in (p, gap)])
    if len(chars) < Q:
        return out
    at, gram = shared_grams(block, table, chars)
    if not len(at):
        return out
    best: dict[tuple[int, int], tuple] = {}  # edits, item_start, begin and end among the document's characters

    def reach(regions: np.ndarray) -> tuple[list[int], list[int]]:
        """First and last document that the windows of each region can touch."""
        item, diagonal, low, high = regions
        last = high + diagonal + 2 * (block.edits[item] + 1) + block.window[item]
        return tuple(
            (np.searchsorted(begin, np.clip(x, 0, len(chars) - 1), side="right") - 1).tolist() for x in (low + diagonal, last)
        )

    def still_open(regions: np.ndarray, nth: int) -> np.ndarray:
        """Regions whose windows from the nth on may give a better row than the texts in reach have."""
        if not best:
            return regions
        keep = np.ones(regions.shape[1], bool)
        item, diagonal, low, _ = regions
        starts = low + nth - block.begin[item]
        floor = low + nth + diagonal - block.edits[item]
        rows = zip(item.tolist(), starts.tolist(), floor.tolist(), *reach(regions), strict=True)
        for i, (k, start, least, first, last) in enumerate(rows):
            if best_only:
                keep[i] = any(
                    best.get((d, k), (1,)) >= (0, start, least - int(begin[d])) for d in range(first, last + 1)
                )
            else:
                keep[i] = any((d, k) not in best for d in range(first, last + 1))
        return regions[:, keep]

    def align_windows(item: np.ndarray, diagonal: np.ndarray, window_begin: np.ndarray) -> None:
        for edits, window in sorted(set(zip(block.edits[item].tolist(), block.window[item].tolist(), strict=True))):
            (own,) = np.nonzero((block.edits[item] == edits) & (block.window[item] == window))
            cost, start, end = align(block, chars, window_begin[own], diagonal[own], edits, window)
            (fit,) = np.nonzero(cost <= edits)
            docs = np.searchsorted(begin, np.maximum(start, 0), side="right") - 1
            for i in fit.tolist():
                doc, k = int(docs[i]), int(item[own[i]])
                s, e = int(start[i] - begin[doc]), int(end[i] - begin[doc])
                if 0 <= s < e <= sizes[doc]:
                    row = (int(cost[i]), int(window_begin[own[i]] - block.begin[k]), s, e)
                    best[doc, k] = min(best.get((doc, k), row), row)

    def take(regions: np.ndarray) -> None:
        """Align the windows of the regions, the first of each, then the second of each and so on, some at a
        time; regions that can give no better row any more are left out."""
        nth, waiting, count = 0, [], 0
        while regions.shape[1]:
            for a in range(0, regions.shape[1], ALIGN_AT_ONCE):
                part = regions[:, a : a + ALIGN_AT_ONCE]
                if a:
                    part = still_open(part, nth)
                waiting.append(part[:3] + np.array([[0], [0], [nth]]))
                count += part.shape[1]
                if count >= ALIGN_AT_ONCE:
                    align_windows(*np.concatenate(waiting, axis=1))
                    waiting, count = [], 0
            nth += 1
            regions = regions[:, regions[2] + nth <= regions[3]]
            if not count:
                regions = still_open(regions, nth)
        if count:
            align_windows(*np.concatenate(waiting, axis=1))

    for cut in slices(block, at, gram):
        found = [candidates(block, p, g) for p, g in pairs(block, at[cut], gram[cut])]
        regions = _merged(np.concatenate(found, axis=1)) if found else np.zeros((4, 0), np.int64)
        if not best_only:
            # first the middle window of each region, then every window of the regions of items and
            # documents without a passage yet
            middle = regions.copy()
            middle[2] = middle[3] = (regions[2] + regions[3]) // 2
            take(middle)
        take(still_open(regions, 0))
    for (doc, item), (c, item_start, s, e) in best.items():
        out.append((doc, block.item_id[item], int(places[doc][s]), int(places[doc][e - 1]) + 1, item_start, c))
    return out


def blocks(benchmark: DataFrame, window: int, share: float) -> list:
    """Broadcast blocks of the benchmark; see ``contaminated``."""
    spark = benchmark.sparkSession
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).filter("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-2 * total // BLOCK_CHARS) if total > BLOCK_CHARS else 1
    held = []
    for i in range(n):
        rows = items.filter(F.expr(f"pmod(xxhash64(text), {n}) = {i}")).collect()
        block = build_block([(r["item_id"], r["text"]) for r in sorted(rows, key=str)], window, share)
        held.append(spark.sparkContext.broadcast(block))
    return held


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    share: float = EDIT_SHARE,
) -> DataFrame:
    """doc_id, item_id, doc_start, doc_end, item_start, edits: one row for each document and benchmark item
    that share a passage.

    The benchmark is read in blocks of at most about BLOCK_CHARS characters (one longer item is a block
    of its own), each compared with all documents in one pass without a shuffle; blocks are cut by a hash of the
    text, so equal items stay together. Null and empty texts match nothing. An item of fewer than
    Q letters and digits matches only a document that consists of it. Repeated documents give repeated
    rows; an empty table on either side gives none.
    """
    schema = "doc_id long, item_id long, doc_start long, doc_end long, item_start long, edits long"
    names = [part.split()[0] for part in schema.split(", ")]
    given = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string"))

    def compare(block) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            without_caches("benchmark")
            items = block.value
            table = _filter_table(items)
            for batch in batches:
                texts = text_bytes(batch.column(1))
                ids = batch.column(0).to_pylist()
                for a, b in chunks(texts, TEXT_AT_ONCE):
                    hits = passages(items, table, texts[a:b])
                    columns = list(zip(*[(ids[a + h[0]], *h[1:]) for h in hits], strict=True)) or [()] * 6
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        return map_arrow(given, run, schema)

    return reduce(DataFrame.unionByName, [compare(b) for b in blocks(benchmark, window, share)])


def uncontaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, share: float = EDIT_SHARE
) -> DataFrame:
    """The rows of ``docs`` that share no passage with the benchmark, with all their columns; nothing is
    joined or shuffled, and a null doc_id or a repeated row is no special case."""

    def compare(rows: DataFrame, block) -> DataFrame:
        at = rows.columns.index(text)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            without_caches("benchmark")
            items = block.value
            table = _filter_table(items)
            for batch in batches:
                texts = text_bytes(batch.column(at))
                clean = np.ones(len(texts), bool)
                for a, b in chunks(texts, TEXT_AT_ONCE):
                    for hit in passages(items, table, texts[a:b], best_only=False):
                        clean[a + hit[0]] = False
                yield batch.filter(pa.array(clean))

        return map_arrow(rows, run, rows.schema)

    return reduce(compare, blocks(benchmark, window, share), docs)
