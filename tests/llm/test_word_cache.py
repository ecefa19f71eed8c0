"""Words of the tokenizers: what the cache keeps and what reaches the library."""

import json

import numpy as np
import pyarrow as pa
import pytest

from caseflow.llm import bpe_tree, token_files, wordbpe
from caseflow.llm.common import worker_cache
from caseflow.llm.queries import END_ID, TOKENIZER
from caseflow.llm.wordbpe import WordBpe, WordIds, word_bpe

FORMS = ["Wanderlustig", "wanderlustig,", "WANDERLUSTIG!!", "Übermütigkeiten", "übermütigkeiten.", "ÜBERMÜTIGKEITEN?"]


@pytest.fixture(autouse=True)
def no_cache():
    worker_cache("none", "none", dict)
    yield
    worker_cache("none", "none", dict)


@pytest.fixture
def asked(monkeypatch):
    """The pieces of each call that reaches the library."""
    calls, pieces = [], WordBpe.pieces
    monkeypatch.setattr(WordBpe, "pieces", lambda self, given, *a: calls.append(list(given)) or pieces(self, given, *a))
    return calls


def library(text):
    return word_bpe(TOKENIZER).tokenizer.encode(text or "", add_special_tokens=False).ids


def split(ids, sizes):
    return [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])]


def given_to_workers(module, monkeypatch, call):
    runs = []
    monkeypatch.setattr(module, "map_arrow", lambda df, run, schema: runs.append(run))
    call()
    return runs[0]


def test_forms_of_a_word_go_through_the_tree_once(spark, monkeypatch):
    docs = spark.createDataFrame([], "doc_id long, text string")
    run = given_to_workers(bpe_tree, monkeypatch, lambda: bpe_tree.encode(docs, TOKENIZER, decoded=True))
    built, encode = [], bpe_tree.TreeEncoder.encode
    monkeypatch.setattr(bpe_tree.TreeEncoder, "encode", lambda self, pieces: built.extend(pieces) or encode(self, pieces))
    monkeypatch.setattr(bpe_tree, "CHUNK_BYTES", 8)
    others, words = [], bpe_tree.TreeEncoder.words
    monkeypatch.setattr(bpe_tree.TreeEncoder, "words", lambda self, given: others.extend(given) or words(self, given))
    batch = pa.RecordBatch.from_pydict({"doc_id": range(len(FORMS)), "text": FORMS})
    got = [row for out in run(iter([batch])) for row in out.to_pylist()]
    assert [r["ids"] for r in got] == [library(w) for w in FORMS]
    assert sorted(len(p) for p in built) == [12, 17]  # one of each word
    assert not any(c.isalpha() for word in others for c in word)


def test_new_words_reach_the_library_together(spark, monkeypatch, asked):
    docs = spark.createDataFrame([], "doc_id long, text string")
    run = given_to_workers(token_files, monkeypatch, lambda: token_files.tokenise(docs, TOKENIZER, END_ID))
    texts = [" ".join(f"{a}{b}{c}," for b in "abcdefgh" for c in "klmnop") for a in "qrstuvwxyz"]
    batch = pa.RecordBatch.from_pydict({"doc_id": range(len(texts)), "text": texts})
    *rows, counts = [row for out in run(iter([batch])) for row in out.to_pylist()]
    assert [np.frombuffer(r["ids"], "<u2").tolist() for r in rows] == [[*library(t), END_ID] for t in texts]
    assert int(np.frombuffer(counts["counts"], "<i8").sum()) == sum(len(library(t)) + 1 for t in texts)
    assert [len(pieces) for pieces in asked] == [480]


@pytest.mark.parametrize("words", [WordIds, lambda bpe: bpe_tree.TreeWords(bpe_tree.TreeEncoder(bpe))])
def test_small_caches_and_odd_texts(monkeypatch, words):
    monkeypatch.setattr(wordbpe, "CACHED_TEXT_WORDS", 3)
    monkeypatch.setattr(wordbpe, "GROUP_BYTES", 20)
    words = words(word_bpe(TOKENIZER))
    texts = [*FORMS, None, "", "  \t", "a 1 a. it's <|endoftext|> ... ''s", "x" * 400 + ", " + "x" * 400, "漢字 ab漢", *FORMS[::-1]]
    for _ in range(3):
        for a in range(0, len(texts), 4):
            ids, sizes = words.texts(pa.array(["left out", *texts[a : a + 4]], pa.string()).slice(1))
            assert split(ids, sizes) == [library(t) for t in texts[a : a + 4]]
    assert all(len(word) <= wordbpe.CACHED_WORD_BYTES for word in [*words.kept, *words.older])
    assert len(words.kept) <= 3 + 20
    assert [part.tolist() for part in words.texts(pa.array([], pa.string()))] == [[], []]


def test_bytes_that_are_no_text_count_as_replacement_characters():
    texts = [b"ab\xff cd", b"\xe9. \xc3", b"good \xc3\xa9"]
    ids, sizes = WordIds(word_bpe(TOKENIZER)).texts(pa.array(texts, pa.binary()).view(pa.string()))
    assert split(ids, sizes) == [library(t.decode("utf-8", "replace")) for t in texts]


def test_symbols_that_a_vocabulary_lacks(tmp_path):
    model = {"type": "BPE", "vocab": {"a": 0, "b": 1, "b</w>": 2, "ab</w>": 3, "a</w>": 4}, "merges": ["a b</w>"], "end_of_word_suffix": "</w>"}
    path = tmp_path / "small.json"
    path.write_text(json.dumps({"version": "1.0", "added_tokens": [], "model": model}))
    bpe = WordBpe(str(path))
    for pieces in (["ab", "aab", "b"], ["ab", "acb", "c", "ba"]):
        ids, ends = bpe.pieces(pieces)
        assert split(ids, np.diff(ends, prepend=0)) == [[t.id for t in bpe.model.tokenize(p)] for p in pieces]


def test_ids_without_a_string_decode_to_nothing():
    token = pa.array(["a", "", "c"])
    got = bpe_tree._joined(token, np.array([0, 1, 2, 7, -1, 1, 2, 2]), np.array([3, 0, 3, 2]))
    assert got.to_pylist() == ["a c", "", "", "c c"]
