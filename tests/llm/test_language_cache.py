"""What a worker keeps of the words it has scored, and words scored without a scale."""

import numpy as np
import pytest

from caseflow.llm import language
from caseflow.llm.queries import PIECES


def uneven(size: int) -> np.ndarray:
    weights = np.random.default_rng(7).random((size, 3)) ** 3 + 1e-3
    return weights / weights.sum(axis=0)


def test_words_of_the_older_generation_are_not_scored_again(monkeypatch):
    monkeypatch.setattr(language, "CACHED_WORDS", 2)
    scored, real = [], language.log_likelihoods
    monkeypatch.setattr(language, "log_likelihoods", lambda v, p, words: scored.extend(words) or real(v, p, words))
    scorer = language.Scorer(language.Model(["a", "b", "c"], uneven(language.pieces(PIECES).size), PIECES))
    first = scorer.predict(["one two-three half½way 17".encode()])
    again = scorer.predict(["17 half½way two-three one".encode(), b"17", b""])
    assert first[0] == again[0][:1] and first[1] == pytest.approx(again[1][:1])
    assert again[0][1:] == [language.UNDETERMINED] * 2
    assert scored.count(language.MARK + "one") == 1 and scored.count(language.MARK + "way") == 1


def test_short_words_need_no_scale():
    vocabulary = language.pieces(PIECES)
    probability = uneven(vocabulary.size)
    words = [language.MARK + w for w in ("schlange", "language", "xqzxqzxq", "ΩЖщøñabc")]
    cells = language.lattice(vocabulary, language._code_rows(words))
    sums, scale = language.forward(cells, len(words), len(words[0]), probability)
    plain = language.plain_forward(cells, len(words), len(words[0]), probability)
    assert np.log(plain) == pytest.approx(np.log(sums[-1]) + scale[-1])
