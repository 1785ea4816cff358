"""Hard negatives by one-dimensional distance keys.

A row's score with an anchor is the inner product of their integer vectors. With M the greatest length of a vector, x becomes
x' = (x, sqrt(M^2 - |x|^2)) and an anchor q' = (q, 0): then |q' - x'|^2 = |q|^2 + M^2 - 2 score, so high scores are near points.
`Index` stores every row sorted by (pivot, distance), pivot being the nearest of a few centres and distance the one to it. By the triangle
inequality a point within r of q' whose pivot is p has a key between d(q', p) - r and d(q', p) + r.

`search` finds the k best rows of each anchor within windows of score. A pivot's keys are cut into intervals (cells) of about `PAGE` rows.
For an anchor each cell has a least and a greatest score that the inequality allows. Scans begin with the cells that may hold the best scores
of a window and expand to more (`RINGS`); before each expansion, cells are left out whose greatest score is under the kth that was found, and the search ends
when no cell is left: what was not read is then certified to be worse. Positives are one search, negatives a second one with one
window a positive, so an annulus around the anchor. Scores are exact integers; the bounds are widened by more than their rounding.

A task has at most `2 * PAGE` rows of a cell (a cell that equal vectors fill is dealt into parts) and `ANCHORS` anchors. The driver gets a sample of
`SAMPLE` vectors, from which the pivots are made, and two numbers and a count for each of at most `PIVOTS * CELLS` cells. Every row is indexed.

Defined cases: rows without an id, label or vector, or with a null or non-finite component, take no part; shorter vectors are filled
with zeros; repeated rows are rows of their own, ties of score and id going by the row's number; an anchor without positives or a
positive without negatives has no rows; empty tables give an empty table; other columns are ignored, whatever their names. Squares of lengths must
be under 2^63.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

POSITIVES, NEGATIVES = 5, 10
#: Percent of a positive's score that a negative may have.
LOW, HIGH = 30, 90
#: Vectors that pivots are made from, pivots, cells of a pivot at most, rows of a cell, anchors of a task.
SAMPLE, PIVOTS, CELLS, PAGE, ANCHORS = 1_024, 16, 64, 4_096, 1_024
#: Cells of a window that are scanned before the bounds are looked at again; then all that are left.
RINGS = (4, 32)
LEAST, MOST = -(1 << 62), 1 << 62
#: Share of the squared lengths by which bounds are widened against rounding.
SLACK = 1e-9


def matrix(vectors: pa.ListArray, dims: int) -> np.ndarray:
    """One row a vector, filled with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    values, sizes = vectors.flatten().to_numpy(zero_copy_only=False), np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows: by doubles if none of their sums can be too large for them."""
    if np.abs(a).max(initial=0) * float(np.abs(b).max(initial=0)) * a.shape[1] < 2**52:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def augmented(x: np.ndarray, square: int) -> np.ndarray:
    x = x.astype(np.float64)
    return np.c_[x, np.sqrt(np.maximum(square - (x**2).sum(1), 0))]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * x @ pivots.T, 0))


def centres(x: np.ndarray, n: int = PIVOTS, rounds: int = 8) -> np.ndarray:
    """Some rounds of k-means from the points that are far from each other."""
    found = x[:1]
    while len(found) < min(n, len(np.unique(x, axis=0))):
        found = np.r_[found, x[[distances(x, found).min(1).argmax()]]]
    for _ in range(rounds):
        near = distances(x, found).argmin(1)
        found = np.array([x[near == i].mean(0) if (near == i).any() else p for i, p in enumerate(found)])
    return found


def _placed(pivots: np.ndarray, square: int, dims: int):
    def run(batches):
        for batch in batches:
            far = distances(augmented(matrix(batch.column(3), dims), square), pivots)
            near = far.argmin(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32)), pa.array(far[np.arange(len(near)), near])], ["row", "id", "label", "vec", "pivot", "distance"])

    return run


class Index:
    """All rows by (pivot, distance). rows: (row, id, label, vec), row being unique."""

    def __init__(self, rows: DataFrame, page: int = PAGE):
        square = F.aggregate("vec", F.lit(0).cast("long"), lambda a, x: a + x * x)
        self.dims, self.square = (x or 0 for x in rows.agg(F.max(F.size("vec")), F.max(square)).first())
        sample = rows.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("vec").toArrow()["vec"]
        self.empty = not len(sample)
        if self.empty:
            return
        self.pivots = centres(augmented(matrix(sample, self.dims), self.square))
        kinds = dict(rows.dtypes)
        placed = rows.mapInArrow(_placed(self.pivots, self.square, self.dims), f"row long, id {kinds['id']}, label {kinds['label']}, vec array<long>, pivot int, distance double")
        # sorted, so that a scan of some cells reads the row groups of their keys only
        self.rows = common.materialize(placed.repartitionByRange("pivot", "distance", "row").sortWithinPartitions("pivot", "distance"), "distance-keys")
        shares = [i / CELLS for i in range(1, CELLS)]
        sizes = self.rows.groupBy("pivot").agg(F.count("*").alias("n"), F.percentile_approx("distance", shares).alias("at")).collect()
        every = {r.pivot: max(1, CELLS // max(1, -(-r.n // page))) for r in sizes}
        bounds = {r.pivot: sorted(set(r["at"][every[r.pivot] - 1 :: every[r.pivot]])) for r in sizes}
        of_pivot = F.array(*[F.array(*map(F.lit, bounds.get(p, []))).cast("array<double>") for p in range(len(self.pivots))])
        cell = F.size(F.filter(F.get(of_pivot, F.col("pivot")), lambda b: b < F.col("distance"))) + F.col("pivot") * CELLS
        self.rows = self.rows.withColumn("cell", cell)
        found = self.rows.groupBy("cell").agg(F.count("*").alias("n"), F.min("distance").alias("least"), F.max("distance").alias("most")).orderBy("cell").collect()
        self.cells = np.array([r.cell for r in found])
        self.least, self.most = np.array([r.least for r in found]), np.array([r.most for r in found])
        self.parts = np.array([-(-r.n // (2 * page)) for r in found])
        parts = F.create_map(*[F.lit(int(x)) for both in zip(self.cells, self.parts) for x in both])
        self.rows = self.rows.withColumn("part", F.pmod(F.xxhash64("row"), F.element_at(parts, F.col("cell")).cast("long")).cast("int"))


class Bounds:
    """What a task knows of the index: which scores the cells can hold."""

    def __init__(self, index: Index):
        self.pivots, self.cells, self.least, self.most, self.parts, self.square, self.dims = index.pivots, index.cells, index.least, index.most, index.parts, index.square, index.dims

    def scores(self, vec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, greatest) score of each cell with an anchor."""
        point = np.r_[vec.astype(np.float64), 0.0]
        whole = float((point**2).sum()) + self.square
        far = distances(point[None], self.pivots)[0][self.cells // CELLS]
        slack = SLACK * (whole + self.square) + 1e-3 * np.sqrt(whole) + 1
        nearest = np.maximum(0, np.maximum(far - self.most, self.least - far))
        return (whole - (far + self.most) ** 2) / 2 - slack, (whole - nearest**2) / 2 + slack

    def open(self, vec: np.ndarray, windows: list[dict], known: dict, ring: int) -> dict[int, list[dict]]:
        """cell -> the windows that a scan of it in this ring can still change."""
        least, most = self.scores(vec)
        begin, end = (0, *RINGS)[ring], (*RINGS, len(self.cells))[ring]
        out: dict[int, list[dict]] = {}
        for x in windows:
            able = np.flatnonzero((most >= x["lo"]) & (least <= x["hi"]))
            able = able[np.lexsort((able, np.abs(most[able] + least[able] - 2 * min(x["hi"], self.square)), -np.minimum(most[able], x["hi"])))][begin:end]
            for c in able[most[able] >= known.get(x["w"], LEAST)]:
                out.setdefault(int(c), []).append(x)
        return out


WINDOWS = "array<struct<w:int,lo:long,hi:long>>"


def _asked(bounds: Bounds, ring: int, whole: bool):
    def run(batches):
        """The cells of each anchor, with what a scan needs; or only the cells."""
        for batch in batches:
            rows = batch.to_pylist()
            out, cells = [], set()
            vectors = matrix(batch.column("vec"), bounds.dims)
            for r, vec in zip(rows, vectors):
                for c, windows in bounds.open(vec, r["windows"], dict(r["known"] or ()), ring).items():
                    cells.add(int(bounds.cells[c]))
                    if whole:
                        out += [{"cell": int(bounds.cells[c]), "part": p, "block": r["block"], "q": r["q"], "label": r["label"], "vec": r["vec"], "windows": windows} for p in range(int(bounds.parts[c]))]
                if len(out) >= 4096:
                    yield pa.RecordBatch.from_pylist(out, SENT)
                    out = []
            if whole:
                yield pa.RecordBatch.from_pylist(out, SENT)
            else:
                yield pa.RecordBatch.from_arrays([pa.array(sorted(cells), pa.int32())], ["cell"])

    return run


WINDOW_TYPE = pa.list_(pa.struct([("w", pa.int32()), ("lo", pa.int64()), ("hi", pa.int64())]))
SENT = pa.schema([("cell", pa.int32()), ("part", pa.int32()), ("block", pa.int32()), ("q", pa.int64()), ("label", pa.int64()), ("vec", pa.list_(pa.int64())), ("windows", WINDOW_TYPE)])


def _scan(dims: int, k: int, same: bool):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: dict[str, list] = {"q": [], "w": [], "row": [], "id": [], "score": []}
        if rows.num_rows and anchors.num_rows:
            row, ids, labels = (rows[c].to_numpy() for c in ("row", "id", "label"))
            scores = products(matrix(anchors["vec"], dims), matrix(rows["vec"], dims))
            for q, label, windows, s in zip(*(anchors[c].to_pylist() for c in ("q", "label", "windows")), scores):
                held = np.flatnonzero(((labels == label) == same) & (row != q))
                held = held[np.lexsort((row[held], ids[held], -s[held]))]
                down = -s[held]
                for x in windows:
                    begin, end = np.searchsorted(down, -x["hi"], "left"), np.searchsorted(down, -x["lo"], "right")
                    best = held[begin : min(end, begin + k)]
                    out["q"] += [q] * len(best)
                    out["w"] += [x["w"]] * len(best)
                    for c, v in (("row", row), ("id", ids), ("score", s)):
                        out[c] += v[best].tolist()
        return pa.table({c: pa.array(v, pa.int32() if c == "w" else pa.int64()) for c, v in out.items()})

    return run


def search(index: Index, anchors: DataFrame, k: int, same: bool, block: int = ANCHORS) -> DataFrame:
    """(q, w, row, id, score, rank): each anchor's k best rows of the same label (or of others) in each window. anchors: (q, label, vec, windows)."""
    bounds, found = Bounds(index), None
    n_blocks = max(1, -(-anchors.count() // block))
    anchors = anchors.withColumn("block", F.pmod(F.xxhash64("q"), F.lit(n_blocks)).cast("int"))
    order = Window.partitionBy("q", "w").orderBy(F.desc("score"), "id", "row")
    for ring in range(len(RINGS) + 1):
        known = anchors.withColumn("known", F.lit(None).cast("map<int,long>"))
        if found is not None:
            kth = found.groupBy("q", "w").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") >= k)
            kth = kth.groupBy("q").agg(F.map_from_entries(F.collect_list(F.struct("w", "kth"))).alias("known"))
            known = anchors.join(kth, "q", "left")
        known = known.select("q", "label", "vec", "windows", "block", "known")
        cells = [r.cell for r in known.mapInArrow(_asked(bounds, ring, False), "cell int").distinct().collect()]
        if not cells and found is not None:
            break
        asked = known.mapInArrow(_asked(bounds, ring, True), f"cell int, part int, block int, q long, label long, vec array<long>, {'windows ' + WINDOWS}")
        rows = index.rows.where(F.col("pivot").isin(sorted({c // CELLS for c in cells})) & F.col("cell").isin(cells))
        rows = rows.select("cell", "part", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), "row", "id", "label", "vec")
        new = rows.groupBy("cell", "part", "block").cogroup(asked.groupBy("cell", "part", "block")).applyInArrow(_scan(index.dims, k, same), "q long, w int, row long, id long, score long")
        new = new if found is None else new.unionByName(found.drop("rank"))
        last, found = found, common.materialize(new.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "nearest")
        if last is not None:
            common.discard(last)
    return found


def hard_negatives(df: DataFrame, anchor: Column, id_col: str = "vec_id", vec_col: str = "vec", label_col: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, page: int = PAGE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); vec_col holds integers, `anchor` tells the anchors' rows."""
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    common.bound_batches(df.sparkSession)
    rows = df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull())
    rows = rows.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).cast("array<long>").alias("vec"), F.coalesce(anchor, F.lit(False)).alias("asks"))
    rows = common.materialize(rows, "vectors")
    index = Index(rows.drop("asks"), page)
    if index.empty:
        return df.sparkSession.createDataFrame([], schema)
    window = lambda w, lo, hi: F.struct(F.lit(w).cast("int").alias("w"), F.lit(lo).cast("long").alias("lo"), F.lit(hi).cast("long").alias("hi"))
    anchors = rows.where("asks").select(F.col("row").alias("q"), F.col("id").alias("anchor_id"), "label", "vec")
    near = search(index, anchors.withColumn("windows", F.array(window(0, LEAST, MOST))), positives, same=True)
    # a positive's window: low * positive <= 100 * negative <= high * positive, which no score meets if the positive's is negative
    own = F.struct(F.col("rank").alias("w"), F.expr(f"({low} * score + 99) div 100").alias("lo"), F.expr(f"({high} * score) div 100").alias("hi"))
    windows = near.where("score >= 0").groupBy("q").agg(F.collect_list(own).alias("windows"))
    far = search(index, anchors.join(windows, "q"), negatives, same=False)
    told = near.select("q", F.col("rank").alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).join(anchors.select("q", "anchor_id"), "q")
    return far.join(told, ["q", "w"]).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    df = common.table(spark, sf_dir, "embeddings")
    finite = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    vec = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("long"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(df.select("vec_id", label.alias("label"), F.when(finite, vec).alias("vec")), F.col("vec_id") % 100 == 0)


SQL = {
    "op13_hard_negatives": f"""
WITH v AS (SELECT row_number() OVER () AS rk, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.rk AS q, a.vec_id AS anchor_id, v.rk, v.vec_id, a.label = v.label AS same, list_inner_product(a.vec, v.vec)::BIGINT AS score FROM v a JOIN v ON a.vec_id % 100 = 0 AND a.rk <> v.rk),
p AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id, rk) AS w FROM s WHERE same QUALIFY w <= {POSITIVES}),
n AS (SELECT s.anchor_id, p.vec_id AS positive_id, (row_number() OVER (PARTITION BY q, w ORDER BY s.score DESC, s.vec_id, s.rk))::INT AS rank, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s USING (q) WHERE NOT s.same AND {LOW} * p.score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.score)
SELECT * FROM n WHERE rank <= {NEGATIVES}
"""
}
