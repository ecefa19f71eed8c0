"""Token alignment against every pair of tokens."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from caseflow.llm import token_alignment as ta
from caseflow.llm.common import table
from caseflow.llm.queries import BYTE_LEVEL, BYTE_RANKS, PIECES

TOOLS = ta.Tokenizers(BYTE_LEVEL, BYTE_RANKS, PIECES)
ODD = [
    None, "", " ", "  ", "x ", " x", "a  b   c", "tab\tand\nline \r\n end", "it's don'T <|endoftext|> </s><s>[INST]",
    "x▁y", "é ́x İ ﬁ", "漢字 日本語 😀", "nul\x00byte", "a" * 5000, " " * 3000, "\n" * 2000 + "x", "!?" * 900, "the the the",
]


def spelled(ids, side):
    return [side.token_bytes[i].as_py() for i in ids]


def brute(text):
    """``(ids A, ids B, groups, links, digest)`` by comparing every pair of byte ranges."""
    a = TOOLS.exact.encode(" " + (text or ""), add_special_tokens=False).ids
    b = TOOLS.pieces.encode(text or "")
    parts = spelled(a, TOOLS.a), spelled(b, TOOLS.b)
    if not text or any(b"".join(p) != (" " + text).encode() for p in parts):
        return [], [], 0, [], ""
    ranges = []
    for p in parts:
        ends = np.cumsum([len(x) for x in p]).tolist()
        ranges.append(list(zip([0, *ends[:-1]], ends, strict=True)))
    links, j = [], 0
    for i, (begin, end) in enumerate(ranges[0]):
        while ranges[1][j][1] <= begin:
            j += 1
        k = j
        while k < len(b) and ranges[1][k][0] < end:
            links.append((a[i], b[k]))
            k += 1
    common = sorted({e for _, e in ranges[0]} & {e for _, e in ranges[1]})
    groups, at = [], [0, 0]
    for cut in common:
        sides = []
        for s, ids in enumerate((a, b)):
            begin = at[s]
            while at[s] < len(ids) and ranges[s][at[s]][1] <= cut:
                at[s] += 1
            sides.append(",".join(map(str, ids[begin : at[s]])))
        groups.append("|".join(sides))
    return a, b, len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()


def expected(texts):
    found = [brute(t) for t in texts]
    counts = Counter(pair for f in found for pair in f[3])
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (len(a), len(b), groups, len(links), sum(counts[p] == best[p[1]] for p in links),
         sum(counts[p] for p in links), digest)
        for a, b, groups, links, digest in found
    ]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 400), min_size=1, max_size=60), st.lists(st.integers(1, 400), min_size=1, max_size=60))
def test_gallop_is_the_first_place_not_below(keys, ends):
    keys, ends = np.cumsum(keys), np.cumsum(ends)
    size, ta.GALLOP_KEYS = ta.GALLOP_KEYS, 3
    try:
        assert ta.gallop(keys, ends).tolist() == np.searchsorted(ends, keys).tolist()
    finally:
        ta.GALLOP_KEYS = size


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=80))
def test_both_sides_encode_as_their_libraries(text):
    text = " " + text.encode("utf-8", "replace").decode()
    assert TOOLS.encode_a(text) == TOOLS.exact.encode(text, add_special_tokens=False).ids
    got = np.frombuffer(TOOLS.encode_b([text.encode()])[0], "<u4").tolist()
    assert got == TOOLS.pieces.encode(text[1:]) or text == " "


def test_documents_against_every_pair(spark, docs, monkeypatch):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "the cat"), (3, "the cat"), (None, "the Cat sat"), (None, None)]
    want = sorted(map(repr, ((i, *e) for (i, _), e in zip(rows, expected([t for _, t in rows]), strict=True))))
    for deal, buckets in ((1, 1), (3, 5)):
        given_rows = docs(rows, "chunk long, at int, bucket int, best binary").repartition(deal)
        found = ta.align_documents(given_rows, BYTE_LEVEL, BYTE_RANKS, PIECES, buckets)
        assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        assert sorted(repr(tuple(r)) for r in found.collect()) == want
    assert ta.align_documents(docs(rows).limit(0), BYTE_LEVEL, BYTE_RANKS, PIECES, 4).collect() == []


def test_whole_table(spark, small):
    given_rows = table(spark, small, "documents")
    texts = [(r["doc_id"], r["text"]) for r in given_rows.select("doc_id", "text").collect()]
    want = sorted((i, *e) for (i, _), e in zip(texts, expected([t for _, t in texts]), strict=True))
    got = ta.align_documents(given_rows.repartition(5), BYTE_LEVEL, BYTE_RANKS, PIECES, 8).collect()
    assert sorted(map(tuple, got)) == want


def test_a_text_the_fast_engine_refuses_goes_to_the_library(monkeypatch):
    class Refuses:
        def encode_ordinary(self, text):
            raise ValueError(text)

    tools = ta.Tokenizers(BYTE_LEVEL, BYTE_RANKS, PIECES)
    tools.fast = Refuses()
    assert tools.encode_a(" it's fine") == TOOLS.encode_a(" it's fine")
