"""Quality by a byte-level convolutional network in numpy.

A text's UTF-8 bytes are read in overlapping chunks that cover all of it; a chunk's overlap is longer than a filter, so every
window of the whole text lies in some chunk. Bytes are embedded, and learned filters of `WIDTH` bytes are convolved with each
chunk and max-pooled over it. The maxima over the chunks, the means of the chunks' maxima and the text's length go through one
hidden layer into one probability. Memory is bounded by a chunk and a row of maxima a chunk, whatever the text's length.

The network is learned by gradients of its own (`Network.gradients`) on at most `sample` labelled rows (those of the smallest
hashes) whose crc32(id as text) mod 3 is not 1. The rows are dealt into `PARTS` groups; in each round every group's task
goes on from the common weights with Adam, and the driver averages what they send back, some 4,000 numbers each.
Starting weights, order and batches follow from fixed seeds and hashes, not from how rows are spread.

Defined cases: null text = empty text, scored as a chunk of zeros; null ids are hashed as an empty text; labels other than 0 and 1
are not used, the larger of several labels of an id counts; without usable labels every score is 0.5; repeated rows get a row
each; an empty table gives an empty table; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.5
#: Labelled rows to learn from.
SAMPLE = 4_000
#: Numbers of a byte's embedding, bytes of a filter, filters, hidden units.
DIM, WIDTH, FILTERS, HIDDEN = 8, 6, 24, 12
#: Slope of a maximum under zero, so that no filter stops learning.
LEAK = 0.1
#: Bytes of a chunk and from one chunk's start to the next one's.
CHUNK, STEP = 2_048, 1_984
#: Tasks that learn, rounds of averaging, passes of a round, texts of a batch, the rate of Adam and how fast it falls.
PARTS, ROUNDS, PASSES, BATCH, RATE, DECAY = 4, 12, 2, 8, 0.01, 0.9
#: Chunks whose windows a gradient holds at a time.
SLICE = 256

Weights = dict[str, np.ndarray]

SHAPES = {"embedding": (256, DIM), "filters": (WIDTH * DIM, FILTERS), "shift": (FILTERS,), "hidden": (2 * FILTERS + 1, HIDDEN), "hidden_shift": (HIDDEN,), "out": (HIDDEN,), "out_shift": (1,)}


def starting() -> Weights:
    """The weights before learning; those of the output are zero, so an untrained network says 0.5."""
    rng = np.random.default_rng(12)
    scale = {"embedding": 0.5, "filters": (WIDTH * DIM) ** -0.5, "hidden": (2 * FILTERS) ** -0.5}
    return {k: (rng.standard_normal(shape) * scale.get(k, 0.0)).astype(np.float32) for k, shape in SHAPES.items()}


def packed(weights: Weights) -> bytes:
    return np.concatenate([weights[k].ravel() for k in SHAPES]).astype("<f4").tobytes()


def unpacked(data: bytes) -> Weights:
    flat, out, at = np.frombuffer(data, "<f4"), {}, 0
    for k, shape in SHAPES.items():
        out[k] = flat[at : at + int(np.prod(shape))].reshape(shape).copy()
        at += out[k].size
    return out


class Network:
    def __init__(self, weights: Weights):
        self.w = weights

    def pooled(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, maxima of each chunk and filter, places of the maxima)."""
        data = np.frombuffer(text.ljust(WIDTH, b"\0"), np.uint8)
        starts = [0, *range(STEP, len(data) - (CHUNK - STEP), STEP)]
        most, places = np.empty((len(starts), FILTERS), np.float32), np.empty((len(starts), FILTERS), np.int64)
        for k, start in enumerate(starts):
            seen = self.w["embedding"][data[start : start + CHUNK]]
            windows = np.lib.stride_tricks.as_strided(seen, (len(seen) - WIDTH + 1, WIDTH * DIM), (seen.strides[0], seen.strides[1]))
            found = np.ascontiguousarray(windows) @ self.w["filters"]
            places[k] = found.argmax(0)
            most[k] = found[places[k], np.arange(FILTERS)] + self.w["shift"]
            places[k] += start
        return data, most, places

    def features(self, size: int, most: np.ndarray) -> np.ndarray:
        on = np.where(most > 0, most, LEAK * most)
        return np.concatenate([on.max(0), on.mean(0), [np.log1p(size) / 10]]).astype(np.float32)

    def head(self, features: np.ndarray) -> tuple[np.ndarray, float]:
        hidden = np.tanh(features @ self.w["hidden"] + self.w["hidden_shift"])
        z = float(hidden @ self.w["out"] + self.w["out_shift"][0])
        return hidden, 1 / (1 + float(np.exp(-max(-30.0, min(30.0, z)))))

    def score(self, text: str | None) -> float:
        data = (text or "").encode()
        return self.head(self.features(len(data), self.pooled(data)[1]))[1]

    def gradients(self, text: bytes, label: int) -> Weights:
        """Of the text's logistic loss; what max-pooling let through goes back to the windows that it came from."""
        data, most, places = self.pooled(text)
        features = self.features(len(text), most)
        hidden, p = self.head(features)
        far = p - label
        behind = self.w["out"] * far * (1 - hidden**2)
        down = self.w["hidden"] @ behind
        back = np.tile(down[FILTERS : 2 * FILTERS] / len(most), (len(most), 1))
        back[most.argmax(0), np.arange(FILTERS)] += down[:FILTERS]
        back *= np.where(most > 0, 1, LEAK)
        filters = self.w["filters"].reshape(WIDTH, DIM, FILTERS)
        embedding, kernel = np.zeros((256, DIM)), np.zeros((WIDTH, DIM, FILTERS))
        for i in range(0, len(most), SLICE):
            windows = data[places[i : i + SLICE, :, None] + np.arange(WIDTH)]
            part = back[i : i + SLICE]
            kernel += np.einsum("cf,cfwd->wdf", part, self.w["embedding"][windows])
            np.add.at(embedding, windows, np.einsum("cf,wdf->cfwd", part, filters))
        return {"embedding": embedding, "filters": kernel.reshape(WIDTH * DIM, FILTERS), "shift": back.sum(0), "hidden": np.outer(features, behind), "hidden_shift": behind, "out": hidden * far, "out_shift": np.array([far])}


def learn(weights: Weights, texts: list[bytes], labels: list[int], rate: float, seed: int, passes: int = PASSES) -> Weights:
    """The weights after some passes of Adam over the texts."""
    rng, first, second, step = np.random.default_rng(seed), dict.fromkeys(SHAPES, 0.0), dict.fromkeys(SHAPES, 0.0), 0
    weights = dict(weights)
    for _ in range(passes):
        order = rng.permutation(len(texts))
        for i in range(0, len(order), BATCH):
            network, batch, step = Network(weights), order[i : i + BATCH], step + 1
            each = [network.gradients(texts[j], labels[j]) for j in batch]
            for k in SHAPES:
                g = sum(x[k] for x in each) / len(batch)
                first[k], second[k] = 0.9 * first[k] + 0.1 * g, 0.99 * second[k] + 0.01 * g**2
                weights[k] = (weights[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return weights


def _fit(weights: bytes, rate: float, seed: int):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("place", "ascending"), ("text", "ascending")])
        texts = [(t or "").encode() for t in rows["text"].to_pylist()]
        found = learn(unpacked(weights), texts, rows["label"].to_pylist(), rate, seed)
        return pa.table({"n": pa.array([len(texts)], pa.int64()), "weights": pa.array([packed(found)], pa.binary())})

    return run


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Weights:
    """The learned weights. What is collected is `PARTS` rows of weights a round."""
    fold = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS
    told = labels.where((fold != HELD_OUT) & F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("key"), F.col(label_col).cast("int").alias("label"))
    told = told.groupBy("key").agg(F.max("label").alias("label")).orderBy(F.xxhash64("key"), "key").limit(sample)
    # at most `sample` ids and labels, so the broadcast is bounded by that parameter
    rows = df.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(told), "key")
    place = F.xxhash64("key", F.lit(1))
    rows = rows.select(F.pmod(place, F.lit(PARTS)).cast("int").alias("part"), place.alias("place"), "text", "label")
    rows = common.materialize(rows, "quality-sample")
    weights = starting()
    for k in range(ROUNDS):
        found = rows.groupBy("part").applyInArrow(_fit(packed(weights), RATE * DECAY**k, k), "n long, weights binary").collect()
        if not found:
            break
        found.sort(key=lambda r: bytes(r.weights))  # sums of floats in an order of their own
        total = sum(r.n for r in found)
        each = [(unpacked(bytes(r.weights)), r.n / total) for r in found]
        weights = {name: sum(w[name] * share for w, share in each).astype(np.float32) for name in SHAPES}
    common.discard(rows)
    return weights


def _score(weights: bytes):
    def run(batches):
        network = Network(unpacked(weights))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([network.score(t) for t in batch.column(1).to_pylist()], pa.float64())], ["id", "score"])

    return run


def quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id_col, held_out, score, predicted) of every row; see the module's docstring."""
    common.bound_batches(df.sparkSession)
    weights = packed(train(df, labels, id_col, text_col))
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    told = rows.mapInArrow(_score(weights), f"id {dict(rows.dtypes)['id']}, score double")
    fold = F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")) % FOLDS
    return told.select(F.col("id").alias(id_col), (fold == HELD_OUT).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def op12_quality_cnn(spark, sf_dir: str) -> DataFrame:
    return quality(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
