"""SimHash near-dedup with pigeonring filtering.

Fingerprint: A-Z are lower-cased, words are runs of other than the space and the five ASCII control white-spaces,
shingles are `width` words joined by one space (fewer words: all of them; none: fingerprint 0), each shingle's
XXH64 (seed 42) votes for its bits, and a bit is set if more than half of the shingles, repeats included, set it.

Links: fingerprints that differ in at most `budget` bits. The 64 bits are a ring of budget + 1 segments. By the
pigeonring principle a linked pair has a segment from which every chain of l consecutive segments differs in at
most floor(l * budget / segments) bits: so in none for the first, and the join is on its value; longer chains are
tested before the full Hamming distance.

Segments that more than `hot` different fingerprints share are not paired. Their fingerprints send longer keys: of six
segments the four that are left if any two are taken out, as two bits can touch two segments at most. Pairs that share one are tested on the
ring of six in the same way. A key of four segments that more than `hot` share, as in a large group of near copies, is not
paired either: each of its fingerprints sends itself to the 65 points at most one bit away. Those within two bits meet in
a point, and others never do; a point gets at most 65 fingerprints, so that costs 65 rows a fingerprint however large
the group. No link is lost. (For other budgets every segment value is paired.)

Components are those of the link graph over distinct fingerprints; component_id is the smallest id in them.

Defined cases: null text = empty text; all texts without words are linked (fingerprint 0); repeated rows each get
a row; rows with null ids get the component's smallest id, null if none has one; an empty table gives an empty table.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

BITS, BUDGET, WIDTH, SEED, HOT = 64, 2, 3, 42, 64

#: For each byte, its eight bits as eight byte-wide counters.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).copy().view(np.uint64).ravel()


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """The fingerprint of a UTF-8 text, unsigned."""
    words = text.lower().split()  # on bytes: both are ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    digest = xxhash.xxh64_digest
    digests = b"".join([digest(joined[a:b], SEED) for a, b in zip((ends - lengths).tolist(), ends[width - 1 :].tolist())])
    return majority(np.frombuffer(digests, np.uint8).reshape(-1, 8))


def majority(rows: np.ndarray) -> int:
    """rows: (n, 8) bytes, most significant first. Counters of a byte hold 255 rows at most, so they are summed by as many."""
    n = len(rows)
    sums = np.add.reduceat(_SPREAD[rows], np.arange(0, n, 255), axis=0)
    votes = sums.view(np.uint8).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big")


def _fingerprints(width: int):
    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            prints = np.array([fingerprint(t or b"", width) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], ["id", "fp"])

    return run


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(id, fp) of each row; fp is the fingerprint's bits as a signed long."""
    common.bound_batches(df.sparkSession)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints(width), f"id {dict(rows.dtypes)['id']}, fp long")


def segments(n: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each of n segments."""
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _segment(fp: Column, at: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << width) - 1))


def _chains(a: Column, b: Column, n: int, budget: int) -> list[Column]:
    """For each of n segments in a ring, whether all chains that start there keep their share of the budget."""
    each = [F.bit_count(_segment(a.bitwiseXOR(b), *p)) for p in segments(n)]
    out = []
    for start in range(n):
        chain, total = F.lit(True), F.lit(0)
        for length in range(1, n):
            total = total + each[(start + length - 1) % n]
            chain = chain & (total <= length * budget // n)
        out.append(chain)
    return out


def _pairs(keyed: DataFrame, keys: list[str], keep: Column, budget: int) -> DataFrame:
    """(u, v) of fingerprints of one key that pass the ring's test and then the full distance."""
    left, right = keyed.withColumnRenamed("fp", "u"), keyed.withColumnRenamed("fp", "v")
    met = left.join(right.hint("merge"), keys).where(F.col("u") < F.col("v")).where(keep)
    return met.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= budget).select("u", "v")


def _shared(keyed: DataFrame, keys: list[str], hot: int | None) -> tuple[DataFrame, DataFrame]:
    """keyed's rows whose key 2 to hot fingerprints share, and the fingerprints whose keys more share."""
    sizes = common.materialize(keyed.groupBy(*keys).count().where("count > 1"), "segment-sizes")
    few = sizes if hot is None else sizes.where(F.col("count") <= hot)
    many = sizes.limit(0) if hot is None else sizes.where(F.col("count") > hot)
    rest = keyed.join(many.select(*keys).hint("merge"), keys).select("fp").distinct()
    return keyed.join(few.select(*keys).hint("merge"), keys), common.materialize(rest, "crowded-fingerprints")


def links(prints: DataFrame, budget: int = BUDGET, hot: int = HOT) -> DataFrame:
    """(u, v) pairs that connect just what the pairs within the budget connect. prints: distinct (fp)."""
    u, v = F.col("u"), F.col("v")
    keyed = prints.select("fp", F.posexplode(F.array(*[_segment(F.col("fp"), *p) for p in segments(budget + 1)])).alias("i", "value"))
    few, crowded = _shared(keyed, ["i", "value"], hot if budget == 2 else None)
    # the pair agrees in segment i, so the ring is tested from there
    found = _pairs(few, ["i", "value"], F.get(F.array(*_chains(u, v, budget + 1, budget)), F.col("i")), budget)
    if budget != 2:
        return found
    whole = [((1 << width) - 1) << at for at, width in segments(6)]
    masks = [sum(m for k, m in enumerate(whole) if k not in out) for out in itertools.combinations(range(6), 2)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = crowded.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("i", "value"))
    few, dense = _shared(keyed, ["i", "value"], hot)
    ring = _chains(u, v, 6, budget)
    found = found.unionByName(_pairs(few, ["i", "value"], F.exists(F.array(*ring), lambda x: x), budget))
    flips = F.array(F.lit(0).cast("long"), *[F.shiftleft(F.lit(1).cast("long"), b) for b in range(BITS)])
    points = dense.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    met = points.groupBy("point").agg(F.min("fp").alias("u"), F.collect_set("fp").alias("all")).where(F.size("all") > 1)
    return found.unionByName(met.select("u", F.explode("all").alias("v")).where("u <> v"))


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, budget: int = BUDGET, hot: int = HOT) -> DataFrame:
    """(id_col, fingerprint, component_id) of every row; see the module's docstring."""
    rows = common.materialize(fingerprints(df, id_col, text_col, width), "fingerprints")
    prints = common.materialize(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    roots = components(links(prints.select("fp"), budget, hot))
    rooted = prints.join(roots.withColumnRenamed("u", "fp").hint("merge"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    # a root or a fingerprint can have a third of all rows
    classes = common.materialize(common.skew_join(rooted, named, ["root"]).select("fp", "component_id"), "fingerprint-classes")
    return common.skew_join(rows, classes, ["fp"]).select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op2_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    return simhash_components(common.table(spark, sf_dir, "documents"))
