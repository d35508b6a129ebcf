"""MinHash near-duplicates by an LSH forest: several sorted signature orders.

1. Each text's distinct word shingles give a digest of the set, its size and a MinHash signature of PERMS 16-bit values.
   Equal sets become one class before anything else, so hot groups of copies cost one row each.
2. Each of TREES orders permutes the signature's values; the rows of an order are range-sorted by the permuted signature.
   A row is held against its neighbours in the order, those with the longest common prefix, as long as the prefix has at
   least DEPTH values: against all of a small region; in a crowded one it looks back over its next neighbours, which share
   the more values the more crowded it is, and takes the likeliest. Range sorting splits a crowded region over tasks. A pair
   stays when the signatures agree well enough.
3. Components of the confirmed links grow in rounds. Each round confirms pairs on the full shingle sets, first each row's
   likeliest pairs, then whatever pair still joins two components; pairs within a component need no confirmation.
4. What crowded regions and regions cut between tasks leave unmet is completed exactly (`unmet`): where such a region has rows of several
   components, these rows' sets are joined by their rarest shingles, of which two sets of that similarity must share one. Only pairs
   between components come out, so a group of near copies costs its outliers, not its square.

The forest is probabilistic for pairs in small regions: two sets with similarity 0.8 share DEPTH values in none of TREES orders once in
30,000 pairs.

Edge cases: texts are lower-cased (A-Z) and split at `[\x20\x09-\x0D]`; texts with fewer words than a shingle have their whole
sequence as the one shingle; null, empty and blank texts have no shingles, link with nothing and stay. Repeated rows and equal
texts are one component. Rows with one doc_id are one document, linked through each of its texts; its texts with shingles are one component.
A null doc_id never is the smallest of a component of others. Ties of likeness go to the smaller id. Texts of any length count whole;
an empty table gives an empty result; columns other than doc_id and text aren't read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import textops
from quern.operators.components import connected
from quern.llm.storage import durable, release, table

PERMS = 64
TREES = 20
DEPTH = 4
#: A region of rows with DEPTH equal values is small up to SMALL rows, which all meet; beyond, a row looks back over CROWDED rows.
SMALL, CROWDED = 24, 48
#: Of these, so many of the likeliest are met in each order.
LIKELIEST = 4
#: Signatures that agree in a smaller share of their values are taken to be below the threshold of 0.8.
LEAST_AGREEMENT = 0.56
SEED = 20


def _family(perms: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.Generator(np.random.PCG64(seed))
    return r.integers(1, 2**63, perms, dtype=np.uint64) * np.uint64(2) + np.uint64(1), r.integers(0, 2**63, perms, dtype=np.uint64)


def signatures(h: np.ndarray, begin: np.ndarray, perms: int = PERMS, seed: int = SEED) -> np.ndarray:
    """16-bit MinHash values, texts x perms, of texts that all have shingles."""
    a, b = _family(perms, seed)
    out = np.empty((len(begin) - 1, perms), dtype=">u2")
    for k in range(perms):
        least = np.minimum.reduceat(h * a[k] + b[k], begin[:-1])
        out[:, k] = (textops.mixed(least) >> np.uint64(48)).astype(np.uint16)
    return out


def tree_orders(perms: int = PERMS, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> np.ndarray:
    """For each tree the order of the signature's values; the first trees start with values of their own."""
    r = np.random.Generator(np.random.PCG64(seed + 1))
    starts = np.concatenate([np.arange(perms).reshape(-1, depth) if not k else r.permutation(perms).reshape(-1, depth) for k in range(-(-trees * depth // perms))])[:trees]
    return np.array([[*s, *(x for x in r.permutation(perms) if x not in s)] for s in starts])


def _sign(shingle: int):
    def run(batches):
        for batch in batches:
            for piece in textops.pieces(batch):
                h, begin = textops.text_shingles(textops.texts_of(piece.column("text")), shingle)
                sets = [np.unique(h[a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)]
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                have = np.flatnonzero(np.diff(begin) > 0)
                signed = signatures(h, np.concatenate([begin[have], begin[-1:]])) if len(have) else []
                sigs = [None] * len(sets)
                for k, s in zip(have, signed, strict=True):
                    sigs[k] = s.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id").cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary())],
                    ["doc_id", "n_shingles", "digest", "sig"],
                )

    return run


def _plant(batches):
    """A row for each tree: the signature in the tree's order."""
    orders = tree_orders()
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            sigs = np.frombuffer(b"".join(part.column("sig").to_pylist()), dtype=">u2").reshape(-1, PERMS)
            for t, order in enumerate(orders):
                keys = np.ascontiguousarray(sigs[:, order])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), t, dtype=np.int32)), pa.array([k.tobytes() for k in keys], pa.binary()), part.column("rep")], ["tree", "key", "rep"])


def _neighbours(batches):
    """Pairs of neighbouring rows of sorted trees that agree well enough, with the share of agreeing values; and, without b, the rows of
    regions in which not all rows meet: crowded ones, and the first and last of a task, which other tasks may have a part of.

    A row meets all rows before it in a region of up to SMALL rows. In a crowded region it is held against the CROWDED rows before it,
    which share the longest prefixes with it, and meets the LIKELIEST of them; over all trees these are many.
    """
    most, kept, begun = max(SMALL + 1, CROWDED), None, None  # kept: the last rows before this batch

    def told(a, b, likeness, region):
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b, pa.int64()), pa.array(likeness, pa.float32()), pa.array(region, pa.int64())], ["a", "b", "likeness", "region"])

    def unmet(tree, keys, rep, rows):
        name = textops.mixed(np.ascontiguousarray(keys[rows, :DEPTH]).view(np.uint64)[:, 0] ^ textops.mixed(tree[rows].astype(np.uint64))).view(np.int64)
        none = [None] * len(rows)
        return told(rep[rows], none, none, name)

    for batch in batches:
        if not batch.num_rows:
            continue
        tree = batch.column("tree").to_numpy()
        keys = np.frombuffer(b"".join(batch.column("key").to_pylist()), dtype=np.uint16).reshape(-1, PERMS)
        rep = batch.column("rep").to_numpy()
        begun = begun or (tree[0], keys[0, :DEPTH].copy())
        old = carried = 0
        if kept is not None:
            old, carried = len(kept[0]), kept[3]
            tree, keys, rep = (np.concatenate([x, y]) for x, y in zip(kept, (tree, keys, rep), strict=False))
        new = np.ones(len(tree), dtype=bool)
        new[1:] = (tree[1:] != tree[:-1]) | (keys[1:, :DEPTH] != keys[:-1, :DEPTH]).any(1)
        starts, region = np.flatnonzero(new), np.cumsum(new)
        place = np.arange(len(tree)) - starts[region - 1]  # of a row within its region
        place[: starts[1] if len(starts) > 1 else None] += carried
        crowd = place > SMALL
        for j in np.flatnonzero(place == SMALL + 1):
            crowd[max(j - SMALL - 1, 0) : j] = True
        fresh = np.arange(len(tree)) >= old
        crowd &= fresh | ~np.concatenate([kept[4], np.zeros(len(tree) - old, dtype=bool)]) if kept is not None else fresh
        crowd |= fresh & (tree == begun[0]) & (keys[:, :DEPTH] == begun[1]).all(1)
        yield unmet(tree, keys, rep, np.flatnonzero(crowd))
        said = crowd | (np.concatenate([kept[4], np.zeros(len(tree) - old, dtype=bool)]) if kept is not None else False)
        met: list[tuple] = []
        best, likeliest = np.zeros((LIKELIEST, len(tree))), np.zeros((LIKELIEST, len(tree)), dtype=np.int64)
        for step in range(1, min(most, len(tree) - 1) + 1):
            j = np.flatnonzero(region[step:] == region[:-step]) + step
            if not len(j):
                break
            small = place[j] <= SMALL
            use = (j >= old) & np.where(small, step <= SMALL, step <= CROWDED) & (rep[j] != rep[j - step])
            j, small = j[use], small[use]
            alike = (keys[j] == keys[j - step]).mean(1)
            use = alike >= LEAST_AGREEMENT
            j, small, alike = j[use], small[use], alike[use]
            met.append((j[small], j[small] - step, alike[small]))
            j, alike = j[~small], alike[~small]
            at = j - step
            for top, its in zip(best, likeliest, strict=True):  # each better one takes the place, and what it displaced goes on
                use = alike > top[j]
                old_alike, old_at = top[j], its[j]
                top[j], its[j] = np.where(use, alike, old_alike), np.where(use, at, old_at)
                alike, at = np.where(use, old_alike, alike), np.where(use, old_at, at)
        for top, its in zip(best, likeliest, strict=True):
            j = np.flatnonzero(top)
            met.append((j, its[j], top[j]))
        x, y, alike = (np.concatenate(c) for c in zip(*met, strict=True))
        if len(x):
            a, b = rep[x], rep[y]
            yield told(np.minimum(a, b), np.maximum(a, b), alike.astype(np.float32), [None] * len(a))
        cut = max(len(tree) - most, 0)
        kept = (tree[cut:], keys[cut:], rep[cut:], place[cut], said[cut:])
    if kept is not None:
        tree, keys, rep, _, said = kept
        last = (tree == tree[-1]) & (keys[:, :DEPTH] == keys[-1, :DEPTH]).all(1)
        yield unmet(tree, keys, rep, np.flatnonzero(last & ~said))


def _sets(shingle: int):
    def run(batches):
        for batch in batches:
            for piece in textops.pieces(batch):
                h, begin = textops.text_shingles(textops.texts_of(piece.column("text")), shingle)
                yield pa.RecordBatch.from_arrays([piece.column("rep"), pa.array([np.unique(h[a:b]).tobytes() for a, b in zip(begin[:-1], begin[1:], strict=True)], pa.binary())], ["rep", "set"])

    return run


def _confirm(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = np.concatenate([x, y])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(both) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough."""
    one = pairs.select("a", "b").join(sets.select(F.col("rep").alias("a"), F.col("set").alias("set_a")), "a")
    both = one.join(sets.select(F.col("rep").alias("b"), F.col("set").alias("set_b")), "b").select("a", "b", "set_a", "set_b")
    return both.mapInArrow(_confirm(percent), "a long, b long")


def _shingles(batches):
    """A row for each shingle of a set."""
    for batch in batches:
        for row in range(batch.num_rows):
            values = np.frombuffer(batch.column("set")[row].as_buffer(), dtype=np.int64)
            n = len(values)
            fill = lambda name: pa.array(np.full(n, batch.column(name)[row].as_py(), dtype=np.int64))  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([pa.array(values), fill("rep"), fill("component"), fill("variant"), pa.array(np.full(n, n, dtype=np.int32))], ["s", "rep", "component", "variant", "n"])


def unmet(regions: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs a, b between components that the forest may not have met, among them all that are alike enough.

    regions (rep, region) are rows of regions where not all met. Where such a region has several components, its rows' shingles are sorted
    by how many of these rows have them, the rarest first. Let w be the first shingle that x and y share, at ranks i and j: they share
    |x| - i and |y| - j shingles at most, and must share t / (1 + t) (|x| + |y|) for a similarity of t. So pairs meet at shingles of
    ranks that leave enough after them; an edited copy's own shingles come first and use up its ranks. Of two rows of one shingle at
    least one is not of its largest component, so components don't meet themselves.
    """
    named = regions.join(labels, F.col("rep") == F.col("node"), "left").select("rep", "region", F.coalesce("component", "rep").alias("component"))
    mixed = named.groupBy("region").agg(F.min("component").alias("_a"), F.max("component").alias("_b")).where("_a < _b").select("region")
    rows = named.join(mixed, "region", "left_semi").select("rep", "component").distinct()
    rows = rows.join(sets, "rep").withColumn("variant", F.xxhash64("set"))
    all_of = durable(rows.select("rep", "component", "variant", "set").mapInArrow(_shingles, "s long, rep long, component long, variant long, n int"))
    counts = all_of.groupBy("s").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    listed = all_of.join(counts, "s").groupBy("rep", "component", "variant", "n").agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("l"))
    alone = F.col("n") - F.size("l")  # shingles that no other of these rows has come first
    probe = F.expr(f"n - cast((n * {percent}L + 99) div 100 as int) + 1") - alone
    first = listed.where(probe > 0).select("rep", "component", "n", alone.alias("_a"), F.posexplode(F.slice("l", F.lit(1), probe)).alias("_k", "_e"))
    posts = durable(first.select(F.col("_e.s").alias("s"), "rep", "component", "n", (F.col("n") - F.col("_a") - F.col("_k")).alias("left")))
    release(all_of)
    shares = posts.groupBy("s", "component").agg(F.count(F.lit(1)).alias("c"))
    lists = shares.groupBy("s").agg(F.max_by("component", F.struct("c", "component")).alias("big"), F.count(F.lit(1)).alias("k")).where("k > 1").select("s", "big")
    live = posts.join(lists, "s")
    x = live.where("component != big").select("s", *(F.col(c).alias(f"{c}_x") for c in ("rep", "component", "n", "left")))
    y = live.select("s", "big", *(F.col(c).alias(f"{c}_y") for c in ("rep", "component", "n", "left")))
    enough = f"{100 + percent}L * least(left_x, left_y) >= {percent}L * (n_x + n_y)"
    met = x.join(y, (x["s"] == y["s"]) & F.expr(f"component_x != component_y and (component_y = big or rep_x < rep_y) and {enough}"))
    return met.select(F.least("rep_x", "rep_y").alias("a"), F.greatest("rep_x", "rep_y").alias("b")).distinct()


def link(docs: DataFrame, shingle: int, percent: int = 80) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_shingles, component_id."""
    docs = docs.select("doc_id", "text")
    signed = durable(docs.mapInArrow(_sign(shingle), "doc_id long, n_shingles long, digest binary, sig binary"))
    full = signed.where("digest is not null")
    classes = durable(full.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig")).where("rep is not null"))
    trees = classes.select("rep", "sig").mapInArrow(_plant, "tree int, key binary, rep long")
    ordered = trees.repartitionByRange("tree", "key", "rep").sortWithinPartitions("tree", "key", "rep")
    found = durable(ordered.mapInArrow(_neighbours, "a long, b long, likeness float, region long"))
    pairs = durable(found.where("b is not null").groupBy("a", "b").agg(F.max("likeness").alias("likeness")))
    regions = found.where("b is null").select(F.col("a").alias("rep"), "region")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("rep")).union(regions.select("rep")).distinct()
    texts = docs.join(ends.hint("shuffle_hash"), F.col("doc_id") == F.col("rep"), "inner").select("rep", "text", F.md5("text").alias("_m"))
    texts = texts.dropDuplicates(["rep", "_m"]).select("rep", "text")  # several texts of one doc_id stay: a pair is confirmed through any of them
    sets = durable(texts.mapInArrow(_sets(shingle), "rep long, set binary").where("octet_length(set) > 0"))

    best = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y"), "likeness"), F.struct(F.col("b").alias("x"), F.col("a").alias("y"), "likeness"))).alias("p"))
    best = best.groupBy("p.x").agg(F.max_by(F.col("p.y"), F.struct("p.likeness", -F.col("p.y"))).alias("y"))
    first = best.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    links = durable(confirmed(first, sets, percent).union(same_document(full, classes)))
    labels = connected(links, "a", "b")
    rest = pairs.join(first, ["a", "b"], "left_anti")
    between = across(rest, labels)
    links = durable(confirmed(between, sets, percent).union(links))
    labels = connected(links, "a", "b")
    more = unmet(regions, labels, sets, percent).join(pairs, ["a", "b"], "left_anti")
    links = durable(confirmed(more, sets, percent).union(links))
    labels = connected(links, "a", "b")
    release(found, pairs, sets, links)

    members = full.select("doc_id", "n_shingles", "digest").join(classes.select("digest", "rep"), "digest", "left")
    named = members.join(labels, F.col("rep") == F.col("node"), "left")
    out = named.select("doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id"))
    return out.union(signed.where("digest is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def same_document(full: DataFrame, classes: DataFrame) -> DataFrame:
    """a, b: representatives of the classes that one doc_id's rows are in, where these are several."""
    several = full.where("doc_id is not null").groupBy("doc_id").agg(F.min("digest").alias("_least"), F.max("digest").alias("_most")).where("_least < _most").select("doc_id", "_least")
    tied = full.select("doc_id", "digest").join(several, "doc_id").select("digest", "_least").distinct()
    named = tied.join(classes.select("digest", F.col("rep").alias("a")), "digest").join(classes.select(F.col("digest").alias("_least"), F.col("rep").alias("b")), "_least")
    return named.where("a != b").select("a", "b")


def across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component yet."""
    a = labels.select(F.col("node").alias("a"), F.col("component").alias("_ca"))
    b = labels.select(F.col("node").alias("b"), F.col("component").alias("_cb"))
    named = pairs.join(a, "a", "left").join(b, "b", "left")
    return named.where(F.coalesce("_ca", "a") != F.coalesce("_cb", "b")).select("a", "b")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: components of documents with Jaccard similarity of 0.8 or more on 4-word shingles."""
    linked = link(table(spark, sf_dir, "documents"), 4)
    return linked.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group (5-word shingles, similarity 0.8) with its columns: the one with the smallest doc_id.

    Rows with the same doc_id are one document; rows without a doc_id can't be named in a group and stay.
    """
    kept = link(docs, 5).where("doc_id = component_id").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.where("doc_id is null"))


#: The same rows: shingle sets as lists, pairs by the shingles they share, and the smallest doc_id that links reach.
ORACLE = """WITH RECURSIVE t AS (SELECT DISTINCT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3]) WHEN len(w) > 0 THEN [w] ELSE [] END) AS s FROM t),
c AS (SELECT doc_id, s, len(s) AS n, min(doc_id) OVER (PARTITION BY md5(list_sort(s)::VARCHAR)) AS rep FROM s),
r AS (SELECT doc_id, n, unnest(s) AS g FROM c WHERE doc_id = rep),
p AS (SELECT a.doc_id AS x, b.doc_id AS y FROM r a JOIN r b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * b.n >= 80 * a.n AND 100 * a.n >= 80 * b.n
 GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
e AS (SELECT x, y FROM p UNION SELECT y, x FROM p),
reach AS (SELECT x AS node, x AS seen FROM e UNION SELECT e.y, reach.seen FROM reach JOIN e ON reach.node = e.x),
k AS (SELECT node, min(seen) AS least FROM reach GROUP BY node)
SELECT d.doc_id, c.n::BIGINT AS n_shingles, CASE WHEN c.n = 0 THEN d.doc_id ELSE coalesce(k.least, c.rep) END AS component_id,
 d.doc_id = (CASE WHEN c.n = 0 THEN d.doc_id ELSE coalesce(k.least, c.rep) END) AS kept
FROM documents d JOIN c ON c.doc_id = d.doc_id LEFT JOIN k ON k.node = c.rep"""
