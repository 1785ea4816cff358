"""The byte-level network: passes against plain loops, gradients against differences, and held-out accuracy."""

import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from passagemill.llm import common, quality

from .conftest import ODD


def weights(seed=1):
    rng = np.random.default_rng(seed)
    return {k: rng.normal(size=s).astype(np.float64) * 0.3 for k, s in quality.SHAPES.items()}


def plain_score(w, text):
    """One window of the whole text after the other; only the means are over chunks."""
    data = list(text) + [0] * (quality.WIDTH - len(text))
    found = np.array([np.concatenate([w["embedding"][b] for b in data[i : i + quality.WIDTH]]) @ w["filters"] + w["shift"] for i in range(len(data) - quality.WIDTH + 1)])
    chunks, start = [], 0
    while start == 0 or start + quality.CHUNK - quality.STEP < len(data):
        chunks.append(found[start : start + quality.CHUNK - quality.WIDTH + 1].max(0))
        start += quality.STEP
    on = np.where(np.array(chunks) > 0, chunks, quality.LEAK * np.array(chunks))
    assert np.allclose(np.max(chunks, 0), found.max(0))  # chunks cover every window
    hidden = np.tanh(np.concatenate([on.max(0), on.mean(0), [np.log1p(len(text)) / 10]]) @ w["hidden"] + w["hidden_shift"])
    return 1 / (1 + np.exp(-(hidden @ w["out"] + w["out_shift"][0])))


@pytest.mark.parametrize("n", [0, 1, 5, 6, 7, 99, 100, 101, 190, 191, 192, 1000])
def test_scores_equal_plain_loops(monkeypatch, n):
    monkeypatch.setattr(quality, "CHUNK", 100)
    monkeypatch.setattr(quality, "STEP", 92)
    text = bytes(random.Random(n).choices(range(97, 123), k=n))
    w = weights()
    assert quality.Network(w).score(text.decode()) == pytest.approx(plain_score(w, text), rel=1e-5)


@pytest.mark.parametrize("slice", [1, 256])
def test_gradients_are_those_of_the_loss(monkeypatch, slice):
    monkeypatch.setattr(quality, "CHUNK", 40)
    monkeypatch.setattr(quality, "STEP", 30)
    monkeypatch.setattr(quality, "SLICE", slice)
    text, label, w = b"the quick brown fox ### jumps over 12 lazy dogs and then some more words", 1, weights(2)

    def loss(w):
        p = plain_score(w, text)
        return -np.log(p if label else 1 - p)

    told, rng = quality.Network(w).gradients(text, label), np.random.default_rng(0)
    for k in quality.SHAPES:
        flat = np.flatnonzero(told[k]) if told[k].any() else np.arange(told[k].size)
        for i in rng.choice(flat, 4):
            more, less = ({n: x.copy() for n, x in w.items()} for _ in range(2))
            more[k].flat[i] += 1e-4
            less[k].flat[i] -= 1e-4
            assert told[k].flat[i] == pytest.approx((loss(more) - loss(less)) / 2e-4, rel=2e-2, abs=1e-5), k


def test_weights_go_through_bytes():
    w = quality.starting()
    assert all(np.array_equal(w[k], x) for k, x in quality.unpacked(quality.packed(w)).items())


def test_odd_rows_and_no_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    df = docs(ODD).union(docs(["x", "x"]).withColumn("doc_id", F.lit(None).cast("long")))
    for name in ("id", "key", "place", "part", "label"):
        df = df.withColumn(name, F.lit(1))
    got = quality.quality(df, none).collect()
    assert Counter(r.doc_id for r in got) == Counter([*range(len(ODD)), None, None])
    assert {(r.score, r.predicted) for r in got} == {(0.5, 1)}
    assert {r.doc_id for r in got if r.held_out} == {i for i in [*range(len(ODD))] if zlib.crc32(str(i).encode()) % 3 == 1}
    assert quality.quality(df.limit(0), none).count() == 0
    odd = spark.createDataFrame([(1, None), (2, 7), (None, 1), (3, 0), (3, 1), (5, 0), (77, 1)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in quality.quality(df, odd).collect())


def test_what_is_learned_doesn_t_depend_on_partitions(spark, docs):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["fine", "words", "here"]) + rng.choice(["", "###"][: 1 + i % 2]) for _ in range(9)) for i in range(60)]
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(60)], "doc_id long, quality int")
    one, other = (quality.train(docs(texts).repartition(n), labels.repartition(n)) for n in (1, 5))
    assert quality.packed(one) == quality.packed(other)
    scores = [quality.Network(one).score(t) for t in texts]
    assert np.mean(scores[::2]) > np.mean(scores[1::2]) + 0.3


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.1/documents.parquet"), reason="the driver's tables are not here")
def test_held_out_quality_of_the_driver_s_table(spark):
    d = "/root/testdata/sf0.1"
    told = common.table(spark, d, "labels").select("doc_id", "quality")
    rows = quality.op12_quality_cnn(spark, d).join(told, "doc_id").where("held_out and quality is not null").select("quality", "score", "predicted").collect()
    good, poor = ([r for r in rows if r.quality == q] for q in (1, 0))
    assert len(rows) > 1000 and sum(r.predicted for r in good) >= 0.97 * len(good) and sum(1 - r.predicted for r in poor) >= 0.85 * len(poor)
    ahead = sum((a.score > b.score) + (a.score == b.score) / 2 for a in good for b in poor)
    assert ahead >= 0.985 * len(good) * len(poor)
