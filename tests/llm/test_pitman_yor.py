"""The word model against its definition: counts by brute force, seating against exact posteriors."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from caseflow.llm import pitman_yor as py
from caseflow.llm import queries
from caseflow.llm.common import table
from caseflow.llm.seating import Seating

SMALL_SETTINGS = py.Settings(contexts=8, endings=4, chunk_words=50)


@pytest.mark.parametrize("customers", [2, 3, 4])
def test_seating_reaches_the_posterior(customers):
    """Partitions of a dish's customers weigh the product of what its steps weigh."""
    discount, weight, dishes = 0.6, 0.7, 40_000

    def partitions(left):
        if not left:
            yield []
            return
        for rest in partitions(left - 1):
            yield [*rest, 1]
            for i in range(len(rest)):
                yield [*rest[:i], rest[i] + 1, *rest[i + 1 :]]

    odds = Counter()
    for sizes in partitions(customers):
        odds[len(sizes)] += weight ** len(sizes) * math.prod(math.prod(n - discount for n in range(1, s)) for s in sizes)
    rng = np.random.default_rng(5)
    each = np.full(dishes, weight)
    seated = Seating(np.full(dishes, customers), discount, each, rng, 25)
    for _ in range(25):
        seated.sweep(each, rng)
    assert seated.sizes.sum() == customers * dishes
    found = np.bincount(seated.tables(), minlength=customers + 1) / dishes
    total = sum(odds.values())
    for tables in range(1, customers + 1):
        assert found[tables] == pytest.approx(odds[tables] / total, abs=0.012)


def test_large_dishes_keep_their_customers_and_order():
    customers = np.array([1, 5000, 2, 40, 33, 32, 100_000, 1, 7])
    weight = np.linspace(0.01, 30, len(customers))
    rng = np.random.default_rng(1)
    seated = Seating(customers, 0.8, weight, rng, 4)
    for _ in range(4):
        seated.sweep(weight, rng)
    tables = seated.tables()
    assert seated.sizes.sum() == customers.sum() and (seated.sizes >= 0).all()
    assert ((tables >= 1) & (tables <= customers)).all() and tables[0] == tables[7] == 1
    assert (seated.sizes > 0).sum() == tables.sum()


@pytest.mark.parametrize("customers, weight", [(20, 3.0), (700, 4.0), (1500, 5.0), (6000, 12.0)])
def test_tables_follow_their_law(customers, weight):
    """All customers of a dish are seated anew, however many they are: the odds of t tables come customer by customer."""
    discount, dishes = 0.8, 400
    odds, t = np.zeros(200), np.arange(200)
    odds[1] = 1
    for n in range(1, customers):
        odds[1:] = np.maximum(n - discount * t[1:], 0) * odds[1:] + weight * odds[:-1]
        odds /= odds.sum()
    mean = (odds * t).sum()
    error = np.sqrt((odds * (t - mean) ** 2).sum() / dishes)
    rng, each = np.random.default_rng(11), np.full(dishes, weight)
    seated = Seating(np.full(dishes, customers), discount, each, rng, 3)
    assert abs(seated.tables().mean() - mean) < 4 * error
    seated.sweep(each, rng)
    assert abs(seated.tables().mean() - mean) < 4 * error
    assert seated.sizes.sum() == customers * dishes and (seated.sizes > 0).all() and len(seated.sizes) == seated.tables().sum()


def brute(rows):
    words = [(t or "").encode().lower().split() + [py.END] for _, t, _ in rows]
    counts = Counter(w for ws, (_, _, out) in zip(words, rows, strict=True) if not out for w in ws)
    tokens = sum(counts.values())
    return [
        (i, bool(out), len(ws), sum(counts[w] > 0 for w in ws), tokens,
         round(sum(math.log10((counts[w] + 1) / (tokens + len(counts) + 1)) for w in ws), 6))
        for (i, _, out), ws in zip(rows, words, strict=True)
    ]


ROWS = [
    (1, "The cat sat on the mat", False), (1, "The cat sat on the mat", False), (2, None, False), (3, "", True),
    (None, "a dog\tsat on\x0b\x0c the\r\nMAT", False), (None, None, None), (4, "unseen wörds ÄB é", True),
    (5, "the " * 1500, False), (6, "x" * 3000 + " cat", True), (7, "\x1c\x85\xa0 odd", False),
]


@pytest.mark.parametrize("buckets, deal", [(1, 1), (4, 3)])
def test_counts_and_base(spark, buckets, deal):
    given = spark.createDataFrame(ROWS, "doc_id long, text string, held_out boolean")
    given = given.selectExpr("*", "1 as chunk", "2 as at", "3 as n_tokens", "'s' as score").repartition(deal)
    got = py.score_documents(given, buckets, SMALL_SETTINGS)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    found = got.collect()
    assert sorted(repr((*tuple(r)[:5], round(r["base_score"], 6))) for r in found) == sorted(map(repr, brute(ROWS)))
    assert all(r["score"] < 0 for r in found)
    again = sorted(repr((r["doc_id"], round(r["score"], 6))) for r in py.score_documents(given, buckets, SMALL_SETTINGS).collect())
    assert again == sorted(repr((r["doc_id"], round(r["score"], 6))) for r in found)
    assert py.score_documents(given.limit(0), buckets, SMALL_SETTINGS).collect() == []
    unlearned = py.score_documents(given.withColumn("held_out", F.lit(True)), buckets, SMALL_SETTINGS).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in unlearned} == {(0, 0, 0.0, 0.0)}


def test_every_word_is_a_context_of_its_own(spark):
    """Whether sums of a context travel in the vector or by the shuffle, its restaurant is the same."""
    rng = np.random.default_rng(4)
    words = [f"{a}{b}ing" for a in "bcdfgh" for b in "aeiou"]
    rows = [(i, " ".join(words[(i + step) % len(words)] for step in (0, 7, 15)), False) for i in range(15)]  # no pair twice
    rows += [(i, " ".join(rng.permutation(words)[:9]), True) for i in range(15, 20)]
    given = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean").repartition(3)
    scores = []
    for contexts in (0, 1000):
        found = py.score_documents(given, 3, py.Settings(contexts=contexts)).collect()
        scores.append([r["score"] for r in sorted(found, key=lambda r: r["doc_id"])])
    assert scores[0] == pytest.approx(scores[1], rel=1e-9)


def test_probabilities_sum_to_one():
    """Over all training words and one for the rest, in the parent and in every restaurant."""
    rng = np.random.default_rng(2)
    s = py.Settings(contexts=20, endings=3, rounds=4)
    hashes = np.sort(rng.integers(1, 1 << 60, 30).astype(np.uint64))
    context = np.tile(np.arange(s.restaurants), len(hashes))
    learned = rng.poisson(1.5, len(context)) * rng.integers(0, 9, len(context))
    packed = py.pack(hashes, np.full(len(hashes), s.restaurants), context, learned)
    known = py.Known(30, int(learned.sum()), hashes, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    history = []
    for _ in range(4):
        *_, place = py._replayed({"bucket": 0, "pairs": packed}, known, history, s)
        customers, tables, hot, ends = np.split(place.sums(), [s.restaurants, 2 * s.restaurants, 2 * s.restaurants])
        history.append(py.Totals(customers, tables, hot, hot, *ends.tolist()))
        parent = place.parent_probability(history[-1])
        rest = py.base_weight(known, history[-1], s) / (s.parent_strength + history[-1].parent_customers)
        assert parent.sum() + rest == pytest.approx(1)
        in_context = np.bincount(place.context, weights=place.predictive(history[-1]))
        share = (s.strength + s.discount * tables) / (s.strength + customers)
        assert in_context + share * rest == pytest.approx(np.ones(s.restaurants))


def test_held_out_texts_are_likelier_than_by_counts(spark, small):
    found = queries.op12_pitman_yor(spark, small).collect()
    ids = [r["doc_id"] for r in table(spark, small, "documents").select("doc_id").collect()]
    assert sorted(r["doc_id"] for r in found) == sorted(ids)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2) for r in found)
    test = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in test) > sum(r["base_score"] for r in test) + 0.2 * sum(r["n_tokens"] for r in test)


@pytest.mark.parametrize("limit, rows_at_once", [(1, 1), (6, 2), (7, 5), (1000, 3)])
def test_chunks_hold_every_word_in_order(limit, rows_at_once):
    """Words are split and told apart by Arrow, as their definition says; a chunk has names of its own."""
    texts = [None, "", " \t\n", " The cat\x0bTHE\x0c\r\n ", "ÄB é\x1cx \x85 \xa0", "a " * 20, "the end", None, "Z z"]
    table = pa.table({"text": pa.array(texts, pa.string()), "doc_id": [*range(8), None], "held_out": [i % 2 == 0 for i in range(9)]})
    chunks = list(py._chunks(iter(table.to_batches(max_chunksize=rows_at_once)), limit))
    found = []
    for chunk in chunks:
        assert len(set(chunk.names)) == len(chunk.names) and chunk.counts.sum() == len(chunk.ids)
        assert len(chunk.counts) == 1 or chunk.counts.sum() <= 2 * limit + len(chunk.counts)
        words = [chunk.names[i] for i in chunk.ids]
        ends = np.cumsum(chunk.counts)
        found += [(d, out, words[e - n : e]) for d, out, n, e in zip(chunk.doc_ids, chunk.held_out, chunk.counts, ends, strict=True)]
    expected = [(t or "").encode().lower().split() + [py.END] for t in texts]
    assert found == [(None if i == 8 else i, i % 2 == 0, ws) for i, ws in enumerate(expected)]


def test_distinct_keys_ascend():
    keys = np.array([5, 1, 5, 2**63, 0, 1], np.uint64)
    assert py.distinct(keys).tolist() == [0, 1, 5, 2**63] and py.distinct(keys).dtype == np.uint64
    assert py.distinct(keys[:0]).tolist() == []
