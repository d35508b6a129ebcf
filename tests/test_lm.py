"""The language model from all counts, against plain counting."""

import math
from collections import Counter

import pytest

from quern.functions import lm

TEXTS = ["the cat。sat on！the mat", "ёжик в тумане", "a b c", "漢字かな交じり文、です", "x" * 40_000 + "yz", "the " * 300_000 + "qqq"]


def plain(texts):
    """All n-grams of all texts, as CharModel takes them."""
    counts = Counter()
    for t in (lm._DROPPED.sub("", t) for t in texts):
        counts.update(t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1))
    letters = [k for k in counts if len(k) == 1]
    counts[""] = sum(counts[k] for k in letters)
    return lm.CharModel(3, counts, len(letters))


@pytest.mark.parametrize("hot", [0, 3, 50_000])
def test_scores_are_those_of_all_counts(spark, hot):
    """Rare n-grams and letters count, however few are looked up in place."""
    model = plain(TEXTS)
    asked = [*TEXTS, "нет", "zq 字", "", " "]
    rows = spark.createDataFrame([(t,) for t in asked], "text string")
    counts = lm.counted(spark.createDataFrame([(t,) for t in TEXTS], "text string"), "text").persist()
    got = {r["text"]: r["score"] for r in lm.score_by_table(rows, "text", counts, hot=hot).collect()}
    assert set(got) == set(asked)
    for t in asked:
        probs = [p for s in lm.slices(t) for p in model.log_probs(s)]
        assert math.isclose(got[t], sum(probs) / len(probs) if probs else -50.0, rel_tol=1e-9)
        assert math.isclose(got[t], model.score(t), rel_tol=1e-9)


def test_long_sentences_and_texts_are_scored_to_their_end():
    model = lm.CharModel(1, {"": 2, "a": 2}, 2)
    low = model.score("b")
    assert "".join(lm.slices(TEXTS[-1])) == TEXTS[-1] and max(map(len, lm.slices(TEXTS[-1]))) == 16 << 10
    assert model.score("a" * (16 << 10) + "b" * (16 << 10)) < (model.score("a") + low) / 2 + 1e-9
    assert model.score("a\n" * (1 << 19) + "b" * 1000) < model.score("a")
