"""Near-duplicate documents: grams, classes and links against plain ones."""

import random

from quern.functions import text as T
from quern.operators import minhash


def corpus():
    r = random.Random(5)
    word = lambda: "".join(r.choices("abcdeé ßあ", k=5))
    out = []
    for _ in range(12):
        base = [word() for _ in range(r.choice([1, 3, 5, 40, 300]))]
        for _ in range(r.randint(1, 6)):
            copy = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 60))):
                copy[r.randrange(len(copy))] = word()
            out.append(" ".join(copy))
    return [(k, t) for k, t in enumerate([*out, "", "  \n", None])]


def test_grams_are_those_of_the_expression(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    plain = minhash.features(docs, 5, lambda g: T.md5_long(g)).select("doc_id", "tokens", "grams")
    assert sorted(minhash.features(docs, 5, T.md5_long).select("doc_id", "tokens", "grams").collect()) == sorted(plain.collect())


def test_no_link_is_lost_before_grams_are_compared(spark):
    docs, same = minhash.classes(minhash.features(spark.createDataFrame(corpus(), "doc_id long, text string"), 5, T.md5_long))
    docs = docs.persist()
    bands = minhash.bands(docs, 12, 1).persist()
    every, few = minhash.candidates(bands), minhash.likely(bands, docs)
    pairs = lambda df: {(r["id1"], r["id2"]) for r in df.collect()}
    linked = pairs(minhash.verified(every, docs))
    assert pairs(minhash.verified(few, docs)) == linked and len(linked) > 5
    assert linked <= pairs(few) < pairs(every)  # fewer pairs' grams are fetched
    sets = {r["doc_id"]: frozenset(r["grams"]) for r in docs.collect()}
    assert len(set(sets.values())) == len(sets) and not set(sets) & {r["id2"] for r in same.collect()}


def test_edit_distance_is_the_plain_one():
    from quern.functions.vector import edit_distance

    r = random.Random(3)
    for _ in range(400):
        a, b = ([r.choice("abcd") for _ in range(r.randint(0, 90))] for _ in "ab")
        b = [r.choice([t, t, t, "x"]) for t in a] if r.random() < 0.5 else b
        row = list(range(len(b) + 1))
        for k, t in enumerate(a):
            new = [k + 1]
            for j, u in enumerate(b):
                new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (t != u)))
            row = new
        assert edit_distance(a, b) == row[-1]
