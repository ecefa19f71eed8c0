"""Phrases against counting every one of them."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from caseflow.llm import phrases
from tests.llm.conftest import DOCS

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, at_least, percent, top):
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(FOLD)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            total[lang] += len(words)
            for m in range(1, 5):
                f.update((lang, tuple(words[i : i + m])) for i in range(len(words) - m + 1))
    candidates = {k: n for k, n in f.items() if len(k[1]) > 1 and n >= at_least}
    covered = set()
    for (lang, words), n in candidates.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                part = (lang, words[i : i + m])
                if 100 * n >= percent * candidates[part]:
                    covered.add(part)
    found = []
    for (lang, words), a in candidates.items():
        if (lang, words) not in covered:
            cuts = []
            for k in range(1, len(words)):
                left, right = f[lang, words[:k]], f[lang, words[k:]]
                cuts.append((2_000_000 * a // (left + right), k, left, right))
            score, _, left, right = min(cuts)
            found.append((lang, -score, -a, " ".join(words).encode(), left, right))
    result, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(found):
        rank[lang] += 1
        if rank[lang] <= top:
            result.append((lang, rank[lang], phrase.decode(), -a, left, right, total[lang], -score))
    return result


def corpus(n):
    random.seed(n)
    common = ["of", "the", "a", "Ünï", "x\xa0y", "\x1cz", " q", "\x85"]
    rows = []
    for _ in range(n):
        words = random.choices([*common, *(f"w{i}" for i in range(30))], k=random.randint(0, 60))
        text = "".join(w + random.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "\x0b", "\x0c"]) for w in words)
        rows.append((text, random.choice(["en", "en", "fr", None, ""])))
    rows += [("New York City is big. " * 40, "en"), ("to be or not " * 50, "fr"), (None, "en"), (None, None), ("", "de")]
    return rows + rows[:20] + [("all the same words again", "en")] * 60


# containers burst, tries spill, texts go in slices, the filter lets much pass
TIGHT = phrases.Limits(burst=2, trie_phrases=60, task_words=40, flush_words=15, slice_bytes=9, filter_bits=64)


@pytest.mark.parametrize("limits", [phrases.Limits(), TIGHT])
def test_collocations(spark, limits):
    rows = corpus(150)
    given = spark.createDataFrame([(i % 7, t, lang, None, 0) for i, (t, lang) in enumerate(rows)], DOCS)
    given = given.selectExpr("*", "'x' as phrase", "1 as f", "2 as prefix").repartition(3)
    got = phrases.collocations(given, 8, 60, 50, limits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, 8, 60, 50))


def test_nothing_frequent_and_empty(spark):
    rows = spark.createDataFrame([(1, "one two three", "en", None, 0), (None, None, None, None, None)], DOCS)
    assert phrases.collocations(rows).collect() == []
    assert phrases.collocations(rows.limit(0)).collect() == []


def test_trie_keeps_counts_through_bursts_and_spills():
    random.seed(3)
    trie, want = phrases.HatTrie(3, burst=4), Counter()
    out = Counter()
    for _ in range(30):
        keys = sorted({tuple(random.randint(1, 5) for _ in range(3)) for _ in range(40)})
        want.update(keys)
        ids = np.array(keys)
        trie.add(ids[:, 0], (ids[:, 1] << 21) | ids[:, 2], np.ones(len(keys), np.int64))
        for subtree in trie.take(60):
            found = {tuple(i): n for ids, counts in subtree for i, n in zip(ids.tolist(), counts.tolist(), strict=True)}
            assert len({ids[0] for ids in found}) == 1
            out.update(found)
    assert any(isinstance(node, phrases.Branch) for node in trie.root.values())
    for subtree in trie.take(0):
        out.update({tuple(i): n for ids, counts in subtree for i, n in zip(ids.tolist(), counts.tolist(), strict=True)})
    assert trie.phrases == 0 and out == want


def test_scores_are_exact_beyond_64_bits(spark):
    a, part = 9_000_000_000_000, 9_000_000_000_001
    counted = spark.createDataFrame([("en", "x", part), ("en", "y", a)], "lang string, phrase string, f long")
    candidates = spark.createDataFrame([("en", "x y", a)], "lang string, phrase string, a long")
    assert [r["score"] for r in phrases.score(counted, candidates).collect()] == [2_000_000 * a // (part + a)]
