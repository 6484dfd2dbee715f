"""Joins and components against brute force, with large groups, ties and odd input."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import components as cc
from tessera.llm import jaccard, shingles, vectors


def roots(nodes, edges):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            up[n] = up[up[n]]
            n = up[n]
        return n

    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("shape", ["path", "star", "random", "cycle", "empty"])
def test_components(spark, shape):
    rng = random.Random(1)
    edges = {
        "path": [(k, k + 1) for k in rng.sample(range(60), 60)],
        "star": [(99, k) for k in range(40)],
        "random": [(rng.randrange(80), rng.randrange(80)) for _ in range(60)],
        "cycle": [(k, (k + 1) % 12) for k in range(12)],
        "empty": [],
    }[shape]
    out = cc.components(spark.createDataFrame(edges, "a long, b long"))
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert {r["node"]: r["component"] for r in out.collect()} == roots(nodes, edges)


# ---------------------------------------------------------------- shingles and the Jaccard join


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingle_sets(rows):
    out = {}
    for i, text in rows:
        w = words(text)
        out[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    return out


def links(sets):
    return [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]


def test_shingle_hashes_tell_sets_apart():
    texts = ["", " \n", "a", "A", "a b", "b a", "a  b\tc d e", "a b c d e f", "x" * 100_000, "ab c d e f", "a bc d e f", "é É", "a\x00 b", "a\x1cb"]
    sets = shingle_sets(enumerate(texts))
    for i, j in combinations(range(len(texts)), 2):
        a, b = shingles.shingle_set(texts[i]), shingles.shingle_set(texts[j])
        assert len(a) == len(sets[i]) and len(np.intersect1d(a, b)) == len(sets[i] & sets[j])


def family(rng, vocabulary, size, base, edits):
    """Copies of one text with up to ``edits`` words changed each."""
    first = rng.choices(vocabulary, k=base)
    out = []
    for _ in range(size):
        w = list(first)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        out.append(" ".join(w))
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(4000)]
    passage = " ".join(rng.choices(vocabulary, k=50))
    texts = [t for size, base, edits in ((60, 60, 4), (60, 120, 12), (12, 30, 2), (5, 400, 30), (90, 26, 3)) for t in family(rng, vocabulary, size, base, edits)]
    texts += [f"{' '.join(rng.choices(vocabulary, k=rng.randint(5, 90)))} {passage}" for _ in range(70)]
    texts += [passage] * 40 + ["same line"] * 30 + ["one", "One", "", " ", None, "a b c d", "a b c d e", "a b c d e f g h i j", "a b c d e f g h i k"]
    texts += [" ".join(rng.choices(vocabulary, k=rng.randint(1, 60))) for _ in range(40)]
    rng.shuffle(texts)
    return [(3 * k - 50, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize("seed, heavy, sample, block", [(0, 40, 16, 2048), (1, 5, 1, 7), (2, 2, 2, 2048), (3, 40, 1, 16)])
def test_join_loses_and_invents_no_link(spark, monkeypatch, seed, heavy, sample, block):
    monkeypatch.setattr(jaccard, "HEAVY", heavy)
    monkeypatch.setattr(jaccard, "SAMPLE", sample)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    rows = corpus(seed)
    sets = shingle_sets(rows)
    want = roots(sets, links(sets))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("cls", F.lit("clash")).repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(docs).collect()}
    assert got == {i: (len(s), want[i]) for i, s in sets.items()}


def test_borderline_pairs(spark):
    # 36 of 45 shingles in common is 0.8 exactly; one shingle less is not enough
    base = [f"a{k}" for k in range(44)]
    near = base[:40] + [f"b{k}" for k in range(4)]
    far = base[:39] + [f"c{k}" for k in range(5)]
    rows = list(enumerate([" ".join(base), " ".join(near), " ".join(far)]))
    sets = shingle_sets(rows)
    want = roots(sets, links(sets))
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_odd_documents(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "x y"), (2, "X  Y"), (None, "x y"), (None, None), (3, None), (4, "")]
    out = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted(map(tuple, out), key=repr)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (1, 1, 1), (2, 1, 1), (None, 1, None), (None, 0, None), (3, 0, 3), (4, 0, 4)], key=repr)
    assert jaccard.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_common_counts():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 200, rng.integers(1, 60)).astype(np.uint64)) for _ in range(50)]
    a, b = np.arange(30), np.arange(20, 50)
    want = [[len(np.intersect1d(sets[i], sets[j])) for j in b] for i in a]
    got = jaccard._counts(sets, a, b)
    own = (a[:, None] == b[None, :])  # a set with itself does not matter
    assert (np.where(own, 0, got) == np.where(own, 0, want)).all()


# ---------------------------------------------------------------- vectors


def vector_rows(seed):
    rng = np.random.default_rng(seed)
    out = []
    for label in (0, 1, 2):
        for _ in range(12):
            centre = rng.normal(size=16)
            for _ in range(rng.integers(1, 14)):
                out.append((centre + rng.normal(size=16) * 0.12, label))
    out += [(out[0][0], 0)] * 40 + [(out[0][0] * 2, 0), (out[0][0], None)]
    return [(k * 2, [float(x) for x in v], label) for k, (v, label) in enumerate(out)]


@pytest.mark.parametrize("seed, block", [(0, 2048), (1, 9)])
def test_vectors_against_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "RECALL", 0.999999)
    rows = vector_rows(seed)
    x = np.array([v for _, v, _ in rows], dtype=np.float32).astype(float)
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    cosine = x @ x.T
    label = [z for *_, z in rows]
    pairs = [(i, j) for i, j in combinations(range(len(rows)), 2) if label[i] is not None and label[i] == label[j] and cosine[i, j] >= vectors.COSINE]
    want = roots(range(len(rows)), pairs)
    n = np.bincount(np.array(pairs).ravel(), minlength=len(rows))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("key", F.lit("clash"))
    got = {r["vec_id"]: r for r in vectors.near_duplicates(df).collect()}
    assert len(got) == len(rows)
    for k, (i, *_) in enumerate(rows):
        assert (got[i]["component_id"], got[i]["kept"]) == (2 * want[k], want[k] == k)
        assert got[i]["n_links"] == n[k]


def test_recall_at_the_threshold():
    bits, tables = vectors.plan(100_000)
    rng = np.random.default_rng(5)
    a = rng.normal(size=(400, 32))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(axis=1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    other = vectors.COSINE * a + np.sqrt(1 - vectors.COSINE**2) * b
    d = vectors.directions(32, bits, tables)
    same = ((a @ d > 0) == (other @ d > 0)).reshape(len(a), tables, bits).all(axis=2).any(axis=1)
    assert same.mean() > 0.97


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [nan, 1.0], 0), (5, [inf, 1.0], 0), (6, [None, 1.0], 0), (7, [1.0, 0.0], None), (8, [1.0, 0.0], 0), (8, [1.0, 0.0], 0), (9, [1.0, 0.0, 0.0], 0), (None, [1.0, 0.0], 0)]
    out = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    got = sorted(map(tuple, out), key=repr)
    alone = [(k, 0, k, True) for k in (1, 2, 3, 4, 5, 6, 7, 9)]
    assert got == sorted([*alone, (8, 2, 8, True), (8, 2, 8, True), (None, 2, 8, False)], key=repr)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_duplicates(empty).count() == 0


def test_extreme_vectors(spark):
    rows = [(1, [1e200, 1e200]), (2, [2e200, 2e200]), (3, [1e-200, 0.0]), (4, [3e-310, 0.0]), (5, [1e308, -1e308]), (6, [1.0, -1.0]), (7, [-1e200, 0.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["component_id"], r["n_links"]) for r in vectors.near_duplicates(df).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (3, 1), 4: (3, 1), 5: (5, 1), 6: (5, 1), 7: (7, 0)}


def test_index_rows_carry_their_class_and_requirement(spark):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(300)]
    rows = list(enumerate(family(rng, vocabulary, 6, 60, 3) + family(rng, vocabulary, 3, 40, 1)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: shingles.shingle_set(t) for i, t in rows}
    every = np.concatenate([np.unique(s) for s in {s.tobytes(): s for s in sets.values()}.values()])
    keys, counts = np.unique(every, return_counts=True)
    common = keys[counts > 1], counts[counts > 1] * 30  # from four classes on frequent
    want = {}
    for s in sets.values():
        rare, often, k = jaccard.prefix(s, *common)
        for x, flag in [(x, False) for x in rare.view(np.int64).tolist()] + [(x, True) for x in often.view(np.int64).tolist()]:
            want.setdefault((x, len(s), k, flag), set()).add(jaccard.digests(s))
    got = {}
    for r in jaccard._index(docs, common).collect():
        got.setdefault((r["shingle"], r["n"], r["k"], r["often"]), set()).add(r["cls"])
    assert all(k in want for k in got) and any(k[3] for k in got) and any(not k[3] for k in got)
    held = {}
    for (x, *_), classes in want.items():
        held.setdefault(x, set()).update(classes)
    # frequent shingles all stay; rare ones if two classes have them
    assert {k for k in want if k[3] or len(held[k[0]]) > 1} == set(got)
    assert all(len(got[k]) == len(want[k]) for k in got)
