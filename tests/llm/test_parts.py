"""Parts of the operators by themselves, and the pipeline."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_queries import brute_components, documents
from tokenizers import Tokenizer

from quern.llm import boosting, bytebpe, fingerprints, licenses, media, packing, pii, secrets, sharding


def test_sketches_merge_and_estimate():
    r = np.random.default_rng(1)
    a, b = np.unique(r.integers(0, 2**63, 5000, dtype=np.uint64)), np.unique(r.integers(0, 2**63, 3000, dtype=np.uint64))
    both = np.union1d(a, b)
    k = 512
    x, y = a[:k], b[:k]
    assert (fingerprints.merge(x, y, k) == both[:k]).all()
    assert abs(fingerprints.distinct_count(x, k) / (2 * len(a)) - 1) < 0.15  # hashes below 2^63 are half as dense
    part = np.union1d(a[::2], b)[:k]
    assert abs(fingerprints.containment(a[::2][:k], part, k) - 1) < 0.15
    assert fingerprints.resemblance(x, x, k) == 1.0 and (fingerprints.decode(fingerprints.encode(x)) == x).all()


def test_sketches_of_parts_merge_in_a_frame(spark):
    values = [int(v) for v in np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 600)]
    rows = [("k", values[i : i + 40]) for i in range(0, 600, 30)]
    got = fingerprints.merge_parts(spark.createDataFrame(rows, "key string, hashes array<long>"), "key", "hashes", 50).first()["hashes"]
    assert [v % 2**64 for v in got] == sorted(v % 2**64 for v in set(values))[:50]


@pytest.mark.parametrize("seed", range(5))
def test_packing_plans_are_whole_and_tight(seed):
    r = random.Random(seed)
    counts = {}
    for _ in range(r.randint(1, 3000)):
        n = r.choice([r.randint(1, 64), r.randint(1, 20)])
        counts[n] = counts.get(n, 0) + 1
    used, places = dict.fromkeys(counts, 0), {}
    for length, first, n, per, sequence, at in packing.plan(counts, 64):
        assert used[length] == first
        used[length] += n
        for k in range(n):
            places.setdefault(sequence + k // per, []).append((at + length * (k % per), length))
    assert used == counts
    for spots in places.values():
        assert sum(n for _, n in spots) <= 64
        assert [a for a, _ in sorted(spots)] == [sum(n for _, n in sorted(spots)[:k]) for k in range(len(spots))]
    assert len(places) <= -(-sum(n * c for n, c in counts.items()) // 64) + 2


@pytest.mark.parametrize("seed", range(4))
def test_best_fit_decreasing_takes_the_tightest_bin(seed):
    """Classes of sizes are packed as one group after another would be."""
    r = random.Random(seed)
    sizes = [r.choice([r.randint(1, 50), 7]) for _ in range(400)]
    room, plain = [], {}
    for size in sorted(sizes, reverse=True):
        fits = [(c, k) for k, c in enumerate(room) if c >= size]
        if not fits:
            room.append(60)
            fits = [(60, len(room) - 1)]
        k = min(fits)[1]
        room[k] -= size
        plain.setdefault(k, []).append(size)
    lines, bins = sharding.best_fit_decreasing({s: sizes.count(s) for s in sizes}, 60)
    packed = {}
    for size, intervals in lines.items():
        assert [a for a, _, _ in intervals] == [sum(n for _, n, _ in intervals[:k]) for k in range(len(intervals))]
        assert sum(n for _, n, _ in intervals) == sizes.count(size)
        for _, n, k in intervals:
            packed.setdefault(k, []).extend([size] * n)
    assert bins == len(room) and {k: sorted(v) for k, v in packed.items()} == {k: sorted(v) for k, v in plain.items()}
    assert sharding.best_fit_decreasing({s: sizes.count(s) for s in sizes}, 60, bins - 1) is None
    full = [0] * 24
    for size, intervals in sharding.pack_into({s: sizes.count(s) for s in sizes}, 24).items():
        for _, n, k in intervals:
            full[k] += n * size
    assert max(full) <= sum(sizes) / 24 + 50


def test_rank_queue_agrees_with_plain_merging():
    ranks = {bytes([b]): b for b in range(256)} | {p: 256 + k for k, p in enumerate([b"ab", b"aa", b"aab", b"abab", b"ba", b"bab", b"aaaa", b"abb"])}
    bpe, r = bytebpe.ByteBpe(ranks, "(?s).+"), random.Random(4)
    for _ in range(500):
        raw = bytes(r.choices(b"abc", k=r.randint(1, 40)))
        parts = [raw[i : i + 1] for i in range(len(raw))]
        if raw in ranks:
            parts = [raw]
        while True:
            found = [(ranks[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:], strict=False)) if x + y in ranks]
            if not found:
                break
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert bpe.encode_piece(raw) == [ranks[p] for p in parts]


def test_suffix_automaton_gives_matching_statistics():
    r = random.Random(5)
    sequences = [[r.randrange(3) for _ in range(r.randint(1, 30))] for _ in range(4)]
    automaton = licenses.SuffixAutomaton(sequences)
    inside = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    file = [r.randrange(4) for _ in range(300)]
    for i, (matched, state) in enumerate(automaton.stream(file)):
        assert matched == max((n for n in range(i + 2) if n == 0 or tuple(file[i + 1 - n : i + 1]) in inside), default=0)
        if matched:
            suffix = file[i + 1 - matched : i + 1]
            assert automaton.ends[state] == {(w, e) for w, s in enumerate(sequences) for e in range(matched - 1, len(s)) if s[e + 1 - matched : e + 1] == suffix}


def test_licence_texts_are_found_with_edits():
    label, text = licenses.TEMPLATES[0]
    scanner = licenses.default_scanner()
    words = licenses.tokens(text)
    words[10:12] = ["other", "words"]
    chain = scanner.chain(0, scanner.spans(numbered(words))[0])
    assert 0.85 < chain.share < 1 and (chain.start, chain.end) == (0, len(words)) and scanner.found(0, chain) and label == scanner.labels[0]


def numbered(words):
    number = {w.decode(): k for k, w in enumerate(licenses.default_scanner().word_bytes)}
    return [number.get(w, -1) for w in words]


def labels_of(text):
    scanner = licenses.default_scanner()
    return sorted({scanner.labels[w] for w, m in scanner.spans(numbered(licenses.tokens(text))).items() if scanner.found(w, scanner.chain(w, m))})


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Licensed under the BSD License.", []),
        ("The photos are licensed under the Creative Commons", []),
        ("released under the license of the city", []),
        (licenses.TEMPLATES[8][1].replace("This program", "This library"), ["gpl"]),
        ("You may use this software for any purpose. The above copyright notice is there.", []),
        ("All of it is Released under the MIT License, of course.", ["mit"]),
        ("Licensed under CC BY-NC 4.0.", ["cc-by-nc"]),
        ("Licensed under CC BY 4.0.", ["cc-by"]),
        ("x " * 50 + "Licensed under the Apache License, Version 2.0. " + "y " * 50, ["apache"]),
    ],
)
def test_labels_need_what_tells_licences_apart(text, labels):
    assert labels_of(text) == labels


def test_every_template_gives_its_label():
    for label, text in licenses.TEMPLATES:
        assert label in labels_of(text)


@pytest.mark.parametrize("seed", range(6))
def test_chains_agree_with_a_plain_longest_chain(seed):
    """Also when a licence's words come thousands of times."""
    r = random.Random(seed)
    templates = [("a", " ".join(r.choices("stuv", k=30))), ("b", " ".join(r.choices("tuvw", k=20)))]
    scanner = licenses.Scanner(templates)
    number = {w.decode(): k for k, w in enumerate(scanner.word_bytes)}
    file = [w for _ in range(8) for w in r.choice([r.choices("stuvwx", k=12), templates[r.randrange(2)][1].split()[r.randrange(10) :]])]
    spans = scanner.spans([number.get(w, -1) for w in file])
    for which, (_, text) in enumerate(templates):
        t, n = text.split(), len(file)
        runs = set()
        for i in range(n):
            for j in range(len(t)):
                if (i == 0 or j == 0 or file[i - 1] != t[j - 1]) and file[i] == t[j]:
                    k = 0
                    while i + k < n and j + k < len(t) and file[i + k] == t[j + k]:
                        k += 1
                    if k >= licenses.MIN_MATCH:
                        runs.add((i, j, k))
        assert set(spans.get(which, [])) == runs
        inside = {(i + x, j + x) for i, j, k in runs for x in range(k)}
        best = [[0.0] * (len(t) + 1) for _ in range(n + 1)]
        for i in range(n):
            for j in range(len(t)):
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + scanner.weights[which][j] if (i, j) in inside else 0)
        if runs:
            assert scanner.chain(which, spans[which]).share == pytest.approx(best[n][len(t)] / sum(scanner.weights[which]))


def test_markov_models_tell_keys_from_identifiers():
    model = secrets.default_model()
    r = random.Random(99)
    keys = ["".join(r.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=32)) for _ in range(300)]
    names = ["getUserAccountByIdentifier2", "configuration_manager_default_2", "internationalization-support-layer-3", "AbstractSingletonProxyFactoryBean1", "max_connections_per_server_pool_10"]
    assert sum(map(model.is_random, keys)) >= 290 and not any(map(model.is_random, names))


def test_markov_threshold_holds_on_samples_of_another_seed():
    """One ordinary token in MAX_FALSE at most, and plain log-likelihoods agree with the table."""
    model, samples = secrets.default_model(), secrets.labelled_samples(10_000, seed=123)
    ordinary, keys = ([t for t, kind in samples if kind == k] for k in (0, 1))
    assert sum(model.ratio(t) > model.threshold for t in ordinary) <= len(ordinary) / secrets.MAX_FALSE
    assert np.mean([model.is_random(t) for t in keys]) > 0.9
    tiny = secrets.Markov([("ab1", 1), ("aab", 0), ("xx", 0)] * 4)
    n = len(secrets._SYMBOLS)

    def log_share(tokens, x, y, z):
        one, two, three = "".join(tokens), [t[i : i + 2] for t in tokens for i in range(len(t) - 1)], [t[i : i + 3] for t in tokens for i in range(len(t) - 2)]
        p1 = (one.count(z) + 1) / (len(one) + n)
        p2 = (two.count(y + z) + 0.05) / (sum(p[0] == y for p in two) + 0.05 * n)
        p3 = (three.count(x + y + z) + 0.005) / (sum(p[:2] == x + y for p in three) + 0.005 * n)
        return np.log(0.2 * p1 + 0.4 * p2 + 0.4 * p3)

    for x, y, z in ("ab1", "aab", "xxa", "b1a"):
        assert tiny.ratio(x + y + z) == pytest.approx(log_share(["ab1"] * 3, x, y, z) - log_share(["aab", "xx"] * 3, x, y, z))


def test_markov_spans_are_the_random_tokens_outside_base_spans():
    model, r = secrets.default_model(), random.Random(5)
    key = lambda: "".join(r.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=40))
    for _ in range(50):
        text = " ".join(r.choice([key(), "token=" + key(), "ordinary words_and_identifiers_2_here", "0123456789abcdef" * 2]) for _ in range(8))
        base = secrets.base_spans(text)
        inside = {i for _, a, b in base for i in range(a, b)}
        wanted, at = [], 0
        for part in text.split(" "):
            for token in part.split("."):
                if len(token) >= 20 and not inside & set(range(at, at + len(token))) and model.is_random(token):
                    wanted.append(("markov", at, at + len(token)))
                at += len(token) + 1
        assert secrets.model_spans(text, base, model) == wanted


def test_gear_chunks_survive_insertions():
    r = random.Random(6)
    data = bytes(r.choices(range(256), k=300_000))
    one, two = media.chunks(data), media.chunks(data[:1000] + b"inserted" + data[1000:])
    assert b"".join(one) == data and all(len(c) <= media.MAX_CHUNK for c in one)
    assert len(set(one) & set(two)) >= len(one) - 3


def plain_features(text, lexicon):
    """The 16 features, a word at a time."""
    import math
    import re

    from quern.llm import toxicity

    def weights(word):
        return lexicon.get(word, 0.0), max([lexicon.get(word[:k] + "*", 0.0) for k in (4, 5, 6) if len(word) > k], default=0.0)

    rows = []
    for chunk in text.split():
        found = [weights(w) for w in re.findall(r"[^\W\d_]+", chunk.lower())]
        whole, stem = max([a for a, _ in found], default=0.0), max([b for _, b in found], default=0.0)
        letters = len(re.findall(r"[^\W\d_]", chunk.lower()))
        inner = chunk.strip("\"'.,;:!?()[]{}#%&*$-")
        odd = letters > 0 and any(c.isalpha() for c in inner) and not inner.replace("'", "").replace("-", "").isalpha()
        hidden = 0.0
        if odd and not whole:
            top = max(weights("".join(re.findall(r"[^\W\d_]+", inner.lower().translate(toxicity._LEET)))))
            hidden = top if top > stem else 0.0
        upper = sum(c.isupper() for c in chunk)
        you = any(w in toxicity._YOU for w in re.findall(r"[^\W\d_]+", chunk.lower()))
        rows.append((whole, stem, hidden, you, upper, letters, upper > 1 and upper == letters, sum(not c.isalnum() for c in chunk), odd, len(chunk), "!" in chunk))
    n, size = len(rows), max(len(rows), 1)
    total = lambda k: sum(r[k] for r in rows)
    hit = [bool(r[0] or r[1] or r[2]) for r in rows]
    near = [any(rows[j][3] for j in range(max(0, i - 4), min(n, i + 5))) for i in range(n)]
    return [
        total(0) / size, total(1) / size, total(2) / size, sum(r[0] > 0 for r in rows) / size, sum(r[1] > 0 for r in rows) / size, sum(hit), max([max(r[:3]) for r in rows], default=0.0),
        sum(a and b for a, b in zip(hit, near, strict=True)) / max(sum(hit), 1), total(3) / size, total(4) / max(total(5), 1), total(6) / size, total(7) / max(total(9), 1), total(10) / size, total(8) / size, total(5) / size, math.log1p(n),
    ]


def test_toxic_features_agree_with_a_plain_count():
    import pyarrow as pa

    from quern.llm import toxicity

    lexicon = {"idiot": 3.0, "stup*": 1.5, "hatef*": 2.0, "ass": 1.0}
    r = random.Random(8)
    words = ["you", "YOU!", "Your", "idiot", "Idiots,", "1d10t", "stupid", "STUPID!!", "hateful.", "a$$", "fine", "It's", "well-known", "x1", "42", "¡Tú!", "ÉTÉ", "...", "ass", "as"]
    texts = ["", "   ", *(" ".join(r.choices(words, k=r.randint(1, 40))) for _ in range(200))]
    for limit in (3, 60_000):  # also when the table starts anew all the time
        make = toxicity.Featurizer(lexicon, limit)
        got = np.concatenate([make(pa.array(texts[k : k + 20])) for k in range(0, len(texts), 20)])
        assert np.allclose(got, [plain_features(t, lexicon) for t in texts], atol=1e-6)


def test_trees_score_as_a_walk_down_each_tree():
    r = np.random.default_rng(3)
    x, y = r.random((300, 5)), r.integers(0, 2, 300).astype(float)
    fit = boosting.Boosted(trees=7).fit(x, y)
    for row, raw in zip(x[:50], fit.raw(x[:50]), strict=True):
        total = fit.base
        for features, thresholds, value in fit.trees:
            node = 0
            for f, t in zip(features, thresholds, strict=True):
                node = 2 * node + int(row[f[node]] > t[node])
            total += value[node]
        assert raw == pytest.approx(total)


def test_isotonic_fit_is_the_least_squares_one():
    r = np.random.default_rng(4)
    raw, y = np.sort(r.random(40)), r.integers(0, 2, 40).astype(float)
    means = [[y[i : j + 1].mean() for j in range(40)] for i in range(40)]
    wanted = [max(min(means[i][j] for j in range(k, 40)) for i in range(k + 1)) for k in range(40)]  # the max-min formula
    fit = boosting.Isotonic().fit(raw, y)
    pools = np.searchsorted(np.unique(wanted), wanted)
    assert fit.y == pytest.approx(np.unique(wanted)) and fit.x == pytest.approx([raw[pools == k].mean() for k in range(pools.max() + 1)])


def test_trees_and_calibration():
    r = np.random.default_rng(7)
    x = r.random((2000, 4))
    y = ((x[:, 0] > 0.6) ^ (x[:, 1] > 0.7)).astype(float)
    raw = boosting.Boosted().fit(x[:1500], y[:1500]).raw(x[1500:])
    assert ((raw > 0) == y[1500:]).mean() > 0.95
    fit = boosting.Isotonic().fit(raw, y[1500:])
    grid = fit(np.linspace(raw.min(), raw.max(), 50))
    assert (np.diff(grid) >= 0).all() and grid[0] >= 0 and grid[-1] <= 1


@pytest.mark.parametrize("which", ["edge_dir", "null_dir", "empty_dir", "sf_dir"])
def test_pipeline_stages(spark, request, which):
    pipeline = pytest.importorskip("corpus_pipeline")
    folder = request.getfixturevalue(which)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    start = docs.columns
    for k, (name, stage) in enumerate(pipeline.STAGES):
        before = docs
        docs = stage(spark, docs, folder)
        if k < len(pipeline.STAGES) - 1:
            assert docs.columns == start, name
            docs = docs.persist()
        if name == "toxicity":
            from quern.llm import toxicity

            scored = toxicity.scored(before.withColumn("_no", F.monotonically_increasing_id()), toxicity.train(before, spark.read.parquet(f"{folder}/labels.parquet")), ["doc_id", "text"], "_score")
            assert Counter((r["doc_id"], r["text"]) for r in docs.collect()) == Counter((r["doc_id"], r["text"]) for r in scored.collect() if r["_score"] < 0.5)
        if name == "pii_surrogates":
            texts = {}
            for r in pii.anonymised(before.select("doc_id", "text")).collect():
                texts.setdefault(r["doc_id"], []).append(r["text"])
            for r in docs.collect():
                assert r["text"] in texts[r["doc_id"]] and (r["text"] is None or r["n_chars"] == len(r["text"]))
        if name == "best_fit_packing":
            library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
            sizes = Counter((r["doc_id"], len(library.encode(r["text"] or "", add_special_tokens=False).ids) + 1) for r in before.collect())
            packed = docs.collect()
            assert sum(r["length"] for r in packed) == sum(n * k for (_, n), k in sizes.items())
            assert {d for d, _ in sizes} == {r["doc_id"] for r in packed}
        if name == "near_duplicates":
            rows = [(r["doc_id"], r["text"]) for r in before.where("doc_id is not null").collect()]
            if len({d for d, _ in rows}) == len(rows):
                components = brute_components(rows, 5)[1]
                assert sorted(r["doc_id"] for r in docs.where("doc_id is not null").collect()) == sorted(d for d, c in components.items() if d == c)
    assert docs.count() >= before.count()
    assert pipeline.run(spark, folder).count() == docs.count()


def test_edge_documents_are_as_described(edge_dir):
    assert any(t is None for _, t in documents(edge_dir)) and any(len(t or "") > 100_000 for _, t in documents(edge_dir))


def test_media_tables_are_written_and_damage_is_seen(spark):
    """Chunks stand once in the pool, or in their only list; a file whose bytes are others raises."""
    r = random.Random(9)
    shared = "".join(r.choices("abcdefgh ", k=60_000))
    texts = [shared, shared, "own " + "".join(r.choices("xyz ", k=30_000)) + shared, "short", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lists, pool = media.store(docs)
    rows, chunks = lists.collect(), {bytes(c["digest"]) for c in pool.collect()}
    assert pool.count() == len(chunks) > 3
    own = Counter(bytes(k) for x in rows for k, d in zip(x["chunks"], x["own"], strict=True) if d is not None)
    assert max(own.values()) == 1 and not chunks & set(own)
    assert all(bytes(k) in chunks for x in rows for k, d in zip(x["chunks"], x["own"], strict=True) if d is None)
    assert media.read(lists, pool).count() == len(texts)
    flipped = pool.withColumn("data", F.first("data").over(__import__("pyspark").sql.Window.orderBy("digest")))
    with pytest.raises(Exception, match="isn't as it was stored"):
        media.read(lists, flipped).collect()
    with pytest.raises(Exception, match="chunk"):
        media.read(lists, pool.limit(1)).collect()


def test_neighbours_and_texts_of_one_doc_id(spark):
    """Two texts under one doc_id link what is near either of them; a missing doc_id links to the copies of its text."""
    from conftest import words

    from quern.llm import neardup

    a, b = words(21, 80), words(22, 80)
    rows = [(1, a), (1, b), (2, a + " one"), (3, b + " two"), (4, words(23, 50)), (None, a), (None, words(24, 30))]
    got = {(x["doc_id"], x["n_shingles"]): x["component_id"] for x in neardup.link(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()}
    assert {d: c for (d, _), c in got.items() if d is not None} == {1: 1, 2: 1, 3: 1, 4: 4}
    assert got[None, 77] == 1 and got[None, 27] is None
