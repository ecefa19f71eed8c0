"""Token operators against the library itself."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from caseflow.llm import bpe_tree, token_counts, token_files
from caseflow.llm.common import arrow_uri, qualified
from caseflow.llm.queries import END_ID, TOKENIZER
from caseflow.llm.wordbpe import encode_texts, word_bpe
from caseflow.workspace import scratch
from tests.conftest import SMALL

ODD = [
    None, "", " ", "\x0b\x0c\x1c\x85 ", "it's ''s don'T I'LL", "x<|endoftext|>y <|startoftext|>", "a., b!! c...",
    "İstanbul Σας ẞ ﬁ", "é ́x", "漢字 日本語", "A" * 9000, "ab1" * 3000, "!?" * 3000 + "x", "é" * 5000,
]


def library(text):
    tokenizer = word_bpe(TOKENIZER).tokenizer
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_words_encode_as_the_whole(text):
    text = text.encode("utf-8", "replace").decode()
    assert list(encode_texts(TOKENIZER, [text.encode()])[0]) == library(text)


def test_every_latin_character():
    texts = [f"{c}a{c}. B{c}" for c in map(chr, range(0x300)) if not c.isspace() or c == " "]
    assert [list(i) for i in encode_texts(TOKENIZER, [t.encode() for t in texts])] == [library(t) for t in texts]


@pytest.mark.parametrize("leaf", [2, 7, 64])
def test_tree_joins_exactly(leaf):
    random.seed(leaf)
    tree = bpe_tree.TreeEncoder(word_bpe(TOKENIZER), leaf, window=1)
    letters = ["ab", "aeiouthnsr", "!?.-=", "éàüß", "漢字", "x1"]
    words = ["".join(random.choices(random.choice(letters), k=random.randint(1, 300))) for _ in range(80)]
    assert [list(np.frombuffer(i, "<u4")) for i in tree.words(words)] == [library(w) for w in words]


def test_documents_come_through_the_tree(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()
    words = bpe_tree.TreeWords(bpe_tree.TreeEncoder(word_bpe(TOKENIZER)))
    texts = [(r["text"] or "").encode() for r in rows]
    got = words.of([t.split() for t in texts])
    assert [list(np.frombuffer(i, "<u4")) for i in got] == [library(t.decode()) for t in texts]
    long = {s for w in {w for t in texts for w in t.split()} for s in words.tree._pieces(w.decode()) if len(s) > bpe_tree.LEAF}
    assert words.tree.joins >= len(long) > 100


def test_a_long_word_has_few_leaves(monkeypatch):
    monkeypatch.setattr(bpe_tree, "MAX_LEAVES", 16)
    word = "".join(random.Random(1).choices("abcdefghij", k=20_000))
    tree = bpe_tree.TreeEncoder(word_bpe(TOKENIZER))
    assert list(np.frombuffer(tree.words([word])[0], "<u4")) == library(word)
    assert tree.joins == 15


def test_encode_decode_and_counts(spark, docs):
    table = docs([(i, t) for i, t in enumerate(ODD)] + [(3, "tie"), (3, "tie"), (None, "no id")])
    coded = bpe_tree.decode(bpe_tree.encode(table, TOKENIZER, leaf=3), TOKENIZER).collect()
    at_once = bpe_tree.encode(table, TOKENIZER, leaf=3, decoded=True)
    assert at_once.columns == [*[c for c in table.columns if c not in ("text", "ids")], "ids", "decoded"]
    assert sorted(map(repr, at_once.collect())) == sorted(map(repr, coded))
    assert bpe_tree.encode(table.limit(0), TOKENIZER, decoded=True).collect() == []
    tokenizer = word_bpe(TOKENIZER).tokenizer
    assert len(coded) == len(ODD) + 3
    for row in coded[: len(ODD)]:
        ids = library(ODD[row["doc_id"]])
        assert row["ids"] == ids and row["decoded"] == tokenizer.decode(ids, skip_special_tokens=False)
    counted = token_counts.count_tokens(table, TOKENIZER).collect()
    for row in counted[: len(ODD)]:
        text = ODD[row["doc_id"]] or ""
        assert (row["n_bytes"], row["n_tokens"]) == (len(text.encode()), len(library(text)))


def test_whole_tokens_are_single():
    bpe = word_bpe(TOKENIZER)
    whole = token_counts.whole_tokens(bpe)
    assert "the" in whole and len(whole) > 10_000
    assert all(len(bpe.model.tokenize(s)) == 1 for s in list(whole)[:500])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=9), max_size=6))
def test_code_round_trip(lists):
    counts = np.array([len(x) for x in lists], np.int64)
    values = np.array([v for x in lists for v in x], np.uint32)
    control, data, control_sizes, data_sizes = token_files.encode(values, counts)
    assert (control_sizes.sum(), data_sizes.sum()) == (len(control), len(data))
    assert (token_files.decode(control, data, counts) == values).all()


def test_token_files(spark, docs):
    rows = [(7, "b a"), (2, None), (5, ""), (None, "first"), (9, "word " * 3000), (5, "tie")]
    folder = f"file://{scratch(spark, 'tokens')}"
    manifest = token_files.write_tokens(docs(rows), folder, TOKENIZER, END_ID)
    got = [tuple(r) for r in token_files.read_tokens(manifest, folder).collect()]
    got.sort(key=lambda r: r[1])
    assert [r[0] for r in got] == [None, 2, 5, 5, 7, 9]
    assert sum(r[2] for r in got[:-1]) == got[-1][1]
    want = {zlib.crc32(np.array([*library(t), END_ID], "<u4").tobytes()) for _, t in rows}
    assert {zlib.crc32(r[3]) for r in got} == want
    empty = f"file://{scratch(spark, 'tokens')}"
    assert token_files.read_tokens(token_files.write_tokens(docs(rows).limit(0), empty, TOKENIZER, END_ID), empty).count() == 0


def test_token_file_parts(spark, docs):
    """One doc_id on a third of the rows fills several parts; null and the smallest id stay apart."""
    rows = [(i, f"text {i}") for i in range(60)] + [(7, f"copy {i}") for i in range(40)]
    rows += [(None, "none"), (-(1 << 63), "least"), (None, "none")]
    folder = scratch(spark, "tokens")  # no scheme: the file system that Spark takes it for
    manifest = token_files.write_tokens(docs(rows).repartition(4), folder, TOKENIZER, END_ID)
    got = sorted((tuple(r) for r in token_files.read_tokens(manifest, folder).collect()), key=lambda r: r[1])
    key = [-(1 << 63) if r[0] is None else r[0] for r in got]
    assert key == sorted(key) and [r[1] for r in got] == list(np.cumsum([0, *[r[2] for r in got]])[:-1])
    code = lambda t: np.array([*library(t), END_ID], "<u4").tobytes()
    assert sorted(((r[0] is None, r[0] or 0, bytes(r[3])) for r in got)) == sorted((i is None, i or 0, code(t)) for i, t in rows)


def test_ranges_of_a_hot_key():
    cuts = np.array([3, 7, 7, 7, 12])
    ties = np.array([0, 1 << 30, 1 << 31, (1 << 32) - 1], np.uint32)
    assert token_files.range_of(cuts, np.full(4, 7), ties).tolist() == [1, 2, 3, 4]
    assert token_files.range_of(cuts, np.array([2, 5, 9, 13]), ties).tolist() == [0, 1, 4, 5]
    assert token_files.range_of(cuts[:0], np.array([2]), ties[3:]).tolist() == [0]


def test_uris():
    assert arrow_uri("s3a://bucket/x") == "s3://bucket/x"
    assert arrow_uri("file:/tmp/x") == arrow_uri("file:///tmp/x") == "file:///tmp/x"
    assert arrow_uri("hdfs://name:8020/x") == "hdfs://name:8020/x"
    with pytest.raises(ValueError):
        arrow_uri("/tmp/x")


def test_qualified_folder(spark):
    assert qualified(spark, "/tmp/x") == "file:/tmp/x"
    assert qualified(spark, "file:///tmp/x") in ("file:///tmp/x", "file:/tmp/x")
