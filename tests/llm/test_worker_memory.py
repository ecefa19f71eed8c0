"""What a Python worker keeps: the caches of the operator it serves, and nothing that is free."""

import os

import numpy as np
import pyarrow as pa
import pytest

from caseflow.llm import bpe_tree, common, decontaminate, language, simhash
from caseflow.llm.queries import PIECES, TOKENIZER
from caseflow.llm.wordbpe import word_bpe

ROWS = "doc_id long, text string, lang string"


@pytest.fixture
def runs(spark, monkeypatch):
    """The functions that operators give to the workers."""
    given = []
    for module in (simhash, decontaminate, language, bpe_tree):
        monkeypatch.setattr(
            module, "map_arrow", lambda df, run, schema: given.append(run) or spark.createDataFrame([], schema)
        )
    yield given
    common.worker_cache("none", "none", dict)


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(1, "some words of a text", "en"), (2, None, None)], ROWS)


def test_operators_without_caches_drop_those_of_others(spark, docs, runs):
    benchmark = spark.createDataFrame([(1, "a passage of the benchmark that is long enough")], "item_id long, text string")
    simhash.with_fingerprints(docs, 3)
    simhash.fingerprints(docs, 3)
    decontaminate.uncontaminated(docs, benchmark)
    decontaminate.contaminated(docs, benchmark)
    language.word_counts(docs)
    assert len(runs) == 5
    for run in runs:
        common.worker_cache("bpe", "words", lambda: {"many": "words"})
        list(run(iter([])))
        assert {"many": "words"} not in common._held.values()


def test_words_of_an_earlier_model_go(docs, runs):
    size = language.pieces(PIECES).size
    for names in (["a", "b"], ["c"]):
        language.identify(docs, language.Model(names, np.full((size, len(names)), 1 / size), PIECES))
    for run in runs:
        list(run(iter([])))
    scorers = [v for v in common._held.values() if isinstance(v, language.Scorer)]
    assert [s.model.languages for s in scorers] == [["c"]]


def test_free_memory_goes_back_after_each_chunk(docs, runs, monkeypatch):
    freed = []
    for module in (bpe_tree, language):
        monkeypatch.setattr(module, "CHUNK_BYTES", 8)
        monkeypatch.setattr(module, "return_free_memory", lambda: freed.append(1))
    bpe_tree.encode(docs, TOKENIZER, decoded=True)
    size = language.pieces(PIECES).size
    language.identify(docs, language.Model(["a"], np.full((size, 1), 1 / size), PIECES), "text")
    texts = ["one two three", "four five six", None]
    tokens = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "lang": ["a"] * 3, "text": texts})
    whole = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "text": texts, "lang": ["a"] * 3})
    assert sum(len(b) for b in runs[0](iter([tokens]))) == 3 and len(freed) == 3
    assert sum(len(b) for b in runs[1](iter([whole]))) == 3 and len(freed) == 6


def test_the_tokenizer_starts_no_threads(monkeypatch):
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    word_bpe(TOKENIZER)
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
