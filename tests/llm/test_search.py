"""Ranked lexical search and hard negatives, against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from passagemill.llm import hard_negatives as hn
from passagemill.llm import lexical

from .conftest import ODD

# ranked lexical search


def plain_terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lowered)


def brute_rank(docs, items, top):
    """docs, items: (id, text)."""
    terms = [Counter(plain_terms(t)) for _, t in docs]
    n_docs, total = sum(map(bool, terms)), sum(t.total() for t in terms)
    df = Counter(w for t in terms for w in t)
    out = []
    for item, text in items:
        scored = []
        for (doc, _), t in zip(docs, terms):
            if t:
                m = 50 + 50 * t.total() * n_docs // total
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * t[w] // (1000 * t[w] + 20 * m)) for w in set(plain_terms(text)) if t[w])
                if s > 0:
                    scored.append((-s, doc is None, doc if doc is not None else 0, doc))
        out += [(item, k + 1, doc, -s) for k, (s, _, _, doc) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize("text", [None, "", "A-b a1 Éa é", "a" * 50, "x_y`z{Z}[@]", "日本 語,a\x7fb"])
def test_terms(text, monkeypatch):
    for piece in (1, 3, 1 << 20):
        monkeypatch.setattr(lexical, "PIECE", piece)
        found = lexical.counted(None if text is None else text.encode())
        want = Counter(plain_terms(text))
        assert found.pop(lexical.LENGTH) == want.total() and {k.decode(): n for k, n in found.items()} == want


def invented(rng, n, words=60, longest=40):
    vocabulary = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    return [" ".join(rng.choices(vocabulary, weights, k=rng.randint(1, longest))) for _ in range(n)]


@pytest.mark.parametrize("shard, block", [(10**6, 100), (90, 3), (1, 1)])
def test_ranks_equal_brute_force(spark, docs, shard, block):
    rng = random.Random(3)
    texts = invented(rng, 60) + ODD + ["W1 w2, w3!"] * 9
    items = [(i, t) for i, t in enumerate(invented(rng, 7, longest=12))] + [(7, None), (8, "unheard of"), (9, "w1 W1 w1"), (None, "w2 word"), (3, "w5")]
    rows = list(enumerate(texts)) + [(None, "w1 w3"), (None, "w1 w3"), (5, "w2 w4")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for name in ("row", "term", "item", "m", "shard", "block", "score"):
        df = df.withColumn(name, F.lit("other"))
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit(1)).withColumn("w", F.lit(2))
    got = lexical.ranked(df, asked, top=8, shard=shard, block=block)
    assert dict(got.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert sorted(map(tuple, got.collect()), key=str) == brute_rank(rows, items, 8)


def test_no_documents_and_no_items(spark):
    none, some = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.ranked(none, items).count() == 0 == lexical.ranked(some, items.limit(0)).count()
    assert lexical.ranked(some, items).count() == 1


def test_a_shard_stops_before_the_lists_end():
    rng = np.random.default_rng(1)
    n = 4_000
    rows = [(d, t, int(rng.integers(1, 9)), 100) for d in range(n) for t in ("common", "other")] + [(d, "rare", 20, 60) for d in range(30)]
    rows.sort()
    table = pa.table({"row": [r[0] for r in rows], "id": [r[0] for r in rows], "term": [r[1] for r in rows], "tf": [r[2] for r in rows], "m": [r[3] for r in rows]})
    shard = lexical.Shard(table)
    terms = [("common", 5), ("other", 4), ("rare", 9000), ("unknown", 8), ("zero", 0)]
    docs, scores, looked = shard.best(terms, 10)
    weights = dict(terms)
    want = Counter()
    for d, t, tf, m in rows:
        want[d] += weights[t] * (10**9 * tf // (1000 * tf + 20 * m))
    assert list(zip(docs.tolist(), scores.tolist())) == sorted(want.items(), key=lambda x: (-x[1], x[0]))[:10]
    assert looked < n / 4


# hard negatives


def brute_negatives(rows, positives, negatives, low, high):
    """rows: (id, label, vec, asks)."""
    out = []
    n = max((len(v) for _, _, v, _ in rows), default=0)
    vectors = [np.array(list(v) + [0] * (n - len(v)), dtype=object) for _, _, v, _ in rows]
    for i, (a, label, _, asks) in enumerate(rows):
        if not asks:
            continue
        scored = sorted((-int(vectors[i] @ vectors[j]), rows[j][0], j) for j in range(len(rows)) if j != i)
        for s, p, _ in [x for x in scored if rows[x[2]][1] == label][:positives]:
            found = [x for x in scored if rows[x[2]][1] != label and low * -s <= -100 * x[0] <= high * -s][:negatives]
            out += [(a, p, k + 1, x[1], -s, -x[0]) for k, x in enumerate(found)]
    return sorted(out)


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, lab, [int(x) for x in v], a) for i, lab, v, a in rows], "vec_id long, label int, vec array<long>, asks boolean").repartition(3)


def points(rng, n, dims, spread, centres=5):
    middles = rng.normal(size=(centres, dims)) * 100
    return np.floor(middles[rng.integers(0, centres, n)] + rng.normal(size=(n, dims)) * spread).astype(int)


@pytest.mark.parametrize("dims, spread, page", [(3, 10, 20), (16, 40, 60), (2, 0, 16)])
def test_negatives_equal_brute_force(spark, dims, spread, page):
    rng = np.random.default_rng(dims)
    x = points(rng, 400, dims, spread)
    x[50:120] = x[50]  # copies that fill a cell and tie
    rows = [(i, int(rng.integers(0, 3)), x[i], i % 20 == 0) for i in range(len(x))]
    got = hn.hard_negatives(vector_frame(spark, rows), F.col("asks"), positives=3, negatives=4, page=page)
    want = brute_negatives(rows, 3, 4, hn.LOW, hn.HIGH)
    assert want and sorted(map(tuple, got.collect())) == want


def test_odd_vectors(spark):
    rows = [(1, 0, [3, 4], True), (2, 0, [5], False), (3, 1, [1, 1], False), (3, 1, [1, 1], False), (4, 1, [], False), (5, 2, [-9, 0], False), (6, 0, [0, 0, 0], True), (1, 0, [3, 4], True)]
    bad = [(None, 0, [9, 9], True), (8, None, [9, 9], True), (9, 0, None, True)]
    df = vector_frame(spark, rows).union(spark.createDataFrame(bad, "vec_id long, label int, vec array<long>, asks boolean"))
    for name in ("row", "q", "w", "cell", "part", "pivot", "distance", "score", "rank"):
        df = df.withColumn(name, F.lit("x"))
    got = sorted(map(tuple, hn.hard_negatives(df, F.col("asks")).collect()))
    assert got == brute_negatives(rows, 5, 10, hn.LOW, hn.HIGH) and got
    assert hn.hard_negatives(df.limit(0), F.col("asks")).count() == 0
    assert hn.hard_negatives(df, F.lit(None).cast("boolean")).count() == 0


def test_non_finite_components_take_no_part(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (100, [0.4, 0.2], 1), (3, [0.7, 0.2], 2), (4, [nan, 1.0], 2), (5, [inf, 1.0], 2), (6, [None, 1.0], 2), (8, None, 2), (9, [0.6, 0.3], None), (14, [0.8, 0.2], 1)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = hn.op13_hard_negatives(spark, str(tmp_path)).collect()
    # 0 and 14 are divisible by 7, so their label is 2 like that of 3, and 100 alone has label 1
    assert sorted(map(tuple, got)) == [(0, 3, 1, 100, 256 * 179 + 128 * 51, 256 * 102 + 128 * 51), (0, 14, 1, 100, 256 * 204 + 128 * 51, 256 * 102 + 128 * 51)]


def test_bounds_hold_every_score():
    rng = np.random.default_rng(5)
    x = points(rng, 500, 8, 30)
    square = int((x**2).sum(1).max())
    pivots = hn.centres(hn.augmented(x, square), 6)
    far = hn.distances(hn.augmented(x, square), pivots)
    near = far.argmin(1)
    index = type("Known", (), {})()
    index.pivots, index.square, index.dims = pivots, square, 8
    cut = np.median(far.min(1))
    cells = near * hn.CELLS + (far.min(1) > cut)
    index.cells = np.unique(cells)
    index.least = np.array([far.min(1)[cells == c].min() for c in index.cells])
    index.most = np.array([far.min(1)[cells == c].max() for c in index.cells])
    index.parts = np.ones(len(index.cells), int)
    bounds, left_out = hn.Bounds(index), 0
    for q in x[:40]:
        least, most = bounds.scores(q)
        scores = x @ q
        for k, c in enumerate(index.cells):
            assert least[k] <= scores[cells == c].min() and scores[cells == c].max() <= most[k]
        kth = np.sort(scores)[-5]
        left_out += (most < kth).sum()
    assert left_out > 40 * len(index.cells) / 4  # and they prune, where vectors are in groups


def test_products_are_exact():
    a = np.array([[2**40, 1], [3, -5]])
    assert hn.products(a, np.array([[2**20, 1]])).tolist() == [[2**60 + 1], [3 * 2**20 - 5]]
    assert hn.products(a[1:], a[1:]).tolist() == [[34]]
