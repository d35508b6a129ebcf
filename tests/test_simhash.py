"""Near-duplicate paragraphs against every pair held against every other."""

import random

import numpy as np
import pytest

from quern.functions.vector import edit_distance, simhash_words
from quern.operators import simhash


def grams(s, a, b):
    return {s[i : i + n] for n in range(a, b + 1) for i in range(len(s) - n + 1)}


def jaccard(x, y):
    return len(x & y) / len(x | y) if x | y else 0.0


def passes(a, b):
    """All gates, plainly."""
    if abs(len(a) - len(b)) > min(-(-3 * max(len(a), len(b)) // 10), 50):
        return False
    (h1, l1), (h2, l2) = simhash_words(a), simhash_words(b)
    mask = (1 << 64) - 1
    if 128 - ((h1 ^ h2) & mask).bit_count() - ((l1 ^ l2) & mask).bit_count() < 76:
        return False
    if (len(a) + len(b)) / 2 > 30:
        return jaccard(grams(a, 3, 4), grams(b, 3, 4)) >= 0.7
    return jaccard(grams(a, 1, 2), grams(b, 1, 2)) >= 0.6 and edit_distance(list(a), list(b)) < 0.3 * ((len(a) + len(b)) // 2)


def texts(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefghilmnorstu", k=r.randint(2, 8)))
    out = set()
    for _ in range(40):
        base = " ".join(word() for _ in range(r.choice([2, 3, 4, 12, 30, 60])))
        out.add(base)
        for _ in range(r.randint(0, 6)):
            s = list(base)
            for _ in range(r.randint(1, max(1, len(s) // 15))):
                s[r.randrange(len(s))] = r.choice("abcxyz ")
            out.add("".join(s))
    return sorted(out)


def groups_of(names, linked):
    above = {n: n for n in names}

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, b in linked:
        a, b = root(a), root(b)
        above[max(a, b)] = min(a, b)
    return {n: root(n) for n in names}


@pytest.mark.parametrize(("how", "seed"), [("group", 1), ("group", 2), ("sliding", 3)])
def test_groups_are_those_of_all_pairs_that_pass(spark, how, seed):
    every = texts(seed)
    rows = simhash.prepare(spark.createDataFrame([(t, 1) for t in every], "text string, freq long")).persist()
    name = {r["text"]: r["hash"] for r in rows.collect()}
    linked = [(name[a], name[b]) for i, a in enumerate(every) for b in every[:i] if passes(a, b)]
    assert len(linked) > 50
    found = {r["hash"]: r["repr_hash"] for r in getattr(simhash, how)(rows).collect()}
    assert found == groups_of(name.values(), linked)


def test_rotations_are_sorted_and_orders_are_permutations():
    firsts = [o[0] for o in simhash.rotations(5)]
    assert firsts == sorted(set(firsts)) and len(firsts) == 5 and len(simhash.rotations(0)) == 128
    for order in [*simhash.rotations(3), *simhash.shuffled_bits(3)]:
        assert sorted(order) == list(range(128))


def test_equal_bits_grow_with_similarity():
    r = np.random.default_rng(1)
    base = "".join(r.choice(list("abcdefgh "), 300))
    far = "".join(r.choice(list("abcdefgh "), 300))
    bits = lambda a, b: sum(128 // 2 - ((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(simhash_words(a), simhash_words(b), strict=True))
    assert bits(base, base) == 128 > bits(base, base[:-10] + "something.") > bits(base, far)


def test_pair_queries_find_all_pairs_that_pass_the_text_gate(spark, tmp_path):
    from quern.plans import catalog

    every = [t.strip() for t in texts(5) if t.strip()]
    spark.createDataFrame([(k, "\n".join(every[k : k + 9])) for k in range(0, len(every), 9)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    cleaned = {" ".join(t.split()) for t in every}
    wanted = {"short_text_pairs_levenshtein": set(), "ngram_jaccard_pairs": set()}
    for a in cleaned:
        for b in cleaned:
            if a < b and len(a) <= 30 and len(b) <= 30 and jaccard(grams(a, 1, 2), grams(b, 1, 2)) >= 0.6 and edit_distance(list(a), list(b)) < 0.3 * ((len(a) + len(b)) // 2):
                wanted["short_text_pairs_levenshtein"].add((a, b))
            if a < b and len(a) > 30 and len(b) > 30 and jaccard(grams(a, 3, 4), grams(b, 3, 4)) >= 0.7:
                wanted["ngram_jaccard_pairs"].add((a, b))
    for name, pairs in wanted.items():
        assert {(r["a"], r["b"]) for r in catalog.queries()[name](spark, str(tmp_path)).collect()} == pairs and pairs
