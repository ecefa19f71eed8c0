"""Decontamination, SimHash and order MinHash against brute force."""

import hashlib
import random
import re
import tracemalloc

import numpy as np
import pytest
import xxhash

from caseflow.llm import decontaminate as dc
from caseflow.llm import fingerprints, order_minhash, simhash


def edits(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


@pytest.mark.parametrize("letters", ["ab", "abcdefghij"])
def test_passages_equal_brute_force(letters):
    random.seed(len(letters))
    window, share = 40, 0.1

    def some(n):
        return "".join(random.choices(letters, k=n))

    for _ in range(12):
        items = [(k, some(random.choice([5, 9, 14, 30, 40, 55, 90]))) for k in range(5)]
        texts = []
        for _ in range(12):
            piece = list(random.choice(items)[1])
            for _ in range(random.randint(0, 7)):
                at = random.randrange(len(piece) + 1)
                piece[at : at + random.randint(0, 1)] = random.choice([[], [random.choice(letters)]])
            texts.append(some(random.randint(0, 50)) + "".join(piece) + some(random.choice([0, 40])))
        block = dc.build_block(items, window, share)
        hits = dc.passages(block, dc._filter_table(block), [t.encode() for t in texts])
        want = set()
        for n, text in enumerate(texts):
            for k, item in items:
                w = min(window, len(item))
                if len(item) < dc.Q:
                    found = text == item
                else:
                    found = any(edits(item[b : b + w], text) <= dc.budget(w, share) for b in range(len(item) - w + 1))
                if found:
                    want.add((n, k))
        assert {h[:2] for h in hits} == want


def test_contaminated_rows(spark, docs):
    item = "The quick brown fox jumps over the lazy dog while seven wizards mix strange potions at dawn"
    table = docs([(1, f"intro. {item.upper()}!! end"), (2, "clean text"), (3, None), (4, ""), (1, item), (None, item)])
    bench = spark.createDataFrame([(10, item), (11, None), (12, ""), (13, "ok")], "item_id long, text string")
    rows = dc.contaminated(table, bench).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], r["item_id"], r["edits"]) for r in rows) == [
        (False, 1, 10, 0), (False, 1, 10, 0), (True, None, 10, 0),
    ]
    assert (rows[0]["doc_start"], rows[0]["doc_end"]) == (7, 7 + len(item))
    assert sorted(r["doc_id"] for r in dc.uncontaminated(table, bench).collect()) == [2, 3, 4]
    assert dc.contaminated(table.limit(0), bench).count() == 0
    assert dc.contaminated(table, bench.limit(0)).count() == 0


def brute_simhash(text, shingle=3):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if c.isascii() else c for c in text))
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    values = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def test_near_duplicates_equal_brute_force(spark, docs):
    random.seed(3)
    words = [f"w{i}" for i in range(50)]
    base = [random.choices(words, k=120) for _ in range(12)]
    texts = ["", None, " \t", "ONE two", "one TWO", "É é", "x " * 40000]
    for words_of in base:
        for _ in range(6):
            copy = list(words_of)
            copy[random.randrange(120)] = random.choice(words)
            texts.append(" ".join(copy))
    prints = [brute_simhash(t or "") for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    for tile in (4096, 3):
        got = simhash.near_duplicates(docs(list(enumerate(texts))), 3, 3, tile=tile).collect()
        assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {
            i: (f"{p:016x}", find(i)) for i, p in enumerate(prints)
        }
    assert simhash.near_duplicates(docs([]), 3, 3).count() == 0
    repeated = simhash.near_duplicates(docs([(4, "a b c"), (4, "a b c"), (None, "a b c")]), 3, 3).collect()
    assert [r["component_id"] for r in repeated] == [4, 4, 4]


def brute_order_minhash(text):
    points, seen, kmers = [ord(c) for c in text], {}, []
    k = min(order_minhash.K, len(points))
    plain = order_minhash.numbered_kmers(np.array(points, np.uint32)) if points else []
    for i in range(len(points) - k + 1 if points else 0):
        gram = tuple(points[i : i + k])
        seen[gram] = seen.get(gram, 0) + 1
        kmers.append((gram, seen[gram]))
    assert len(set(kmers)) == len(set(np.array(plain).tolist()))  # numbered k-mers stay apart
    out = []
    for mask, factor in zip(order_minhash._MASKS[:, 0], order_minhash._FACTORS[:, 0]):
        hashed = [((int(v) ^ int(mask)) * int(factor) & 0xFFFFFFFF, i) for i, v in enumerate(plain)]
        out.append([kmers[i] for i in sorted(i for _, i in sorted(hashed)[: order_minhash.TUPLE])])
    return out


def test_order_minhash_slots_agree_as_brute_force():
    random.seed(9)
    a = "".join(random.choices("abcd ", k=300))
    texts = [a, a[:200] + "zzz" + a[203:], a[150:] + a[:150], "abc", "", "ab" * 40]
    prints = [order_minhash.fingerprint(order_minhash.code_points(t)) for t in texts]
    brute = [brute_order_minhash(t) for t in texts]
    for x, p in zip(brute, prints):
        for y, q in zip(brute, prints):
            assert [s == t for s, t in zip(x, y)] == (p == q).tolist()


def test_sensitivity_takes_the_next_document(spark, docs):
    rows = [(5, "hello world, hello"), (1, None), (9, "ünï 漢字 text"), (3, "x"), (3, "x"), (1 << 60, "last one here"), ((1 << 60) + 1, "end")]
    ordered = sorted(rows, key=lambda r: r[0])
    for buckets in (1, 4):
        got = sorted(fingerprints.sensitivity(docs(rows), buckets).collect())
        assert len(got) == len(rows)
        for n, r in enumerate(got):
            text, after = ordered[n][1] or "", ordered[(n + 1) % len(rows)][1] or ""
            half = len(text) // 2
            edited = text[: len(text) - half] + after[:half]
            assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            assert (r["doc_id"], r["n_chars"]) == (ordered[n][0], len(text))
            assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert fingerprints.sensitivity(docs([]), 4).count() == 0
    assert fingerprints.sensitivity(docs([(2, "only")]), 4).first()["near_next"] == 1.0
    assert fingerprints.fingerprint(docs([(1, None), (2, "")])).select("fingerprint").distinct().count() == 1


def test_passages_cut_into_parts_are_the_same(monkeypatch):
    random.seed(8)
    items = [(1, "a" * 230), (2, "ab" * 90), (3, "x" * 30 + "a" * 70 + "y" * 20), (4, "abcdefgh" * 20), (5, "a" * 40)]
    texts = ["a" * 700, "z" + "ab" * 300, "c" * 20 + "x" * 28 + "a" * 72 + "y" * 20, "q" * 50, "aab" * 90, "abcdefgh" * 31, "a" * 41]
    texts += ["".join(random.choices("ab", [9, 1], k=300)) for _ in range(3)]
    block = dc.build_block(items, 60, 0.1)
    coded = [t.encode() for t in texts]
    whole = sorted(dc.passages(block, dc._filter_table(block), coded))
    want = {
        (n, k) for n, text in enumerate(texts) for k, item in items
        if any(edits(item[b : b + 60], text) <= dc.budget(min(60, len(item)), 0.1) for b in range(max(1, len(item) - 59)))
    }
    assert {h[:2] for h in whole} == want
    monkeypatch.setattr(dc, "PAIRS", 500)
    monkeypatch.setattr(dc, "ALIGN_AT_ONCE", 64)
    assert sorted(dc.passages(block, dc._filter_table(block), coded)) == whole
    assert {h[:2] for h in dc.passages(block, dc._filter_table(block), coded, best_only=False)} == want
    # alone or beside others, a text has the same passages
    alone = [(n, *h[1:]) for n, t in enumerate(coded) for h in dc.passages(block, dc._filter_table(block), [t])]
    assert sorted(alone) == whole


def test_runs_of_one_character_need_little_memory():
    block = dc.build_block([(1, "a" * 1500)])
    tracemalloc.start()
    hits = dc.passages(block, dc._filter_table(block), [b"-" + b"a" * 6000])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert hits == [(0, 1, 1, 101, 0, 0)] and peak < 400 << 20
