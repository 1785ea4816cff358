"""Near-dedup at Jaccard similarity 0.8 of five-word shingles: the pipeline's stage of SimHash near-dedup.

Words are as in `simhash`; a text's set is that of the XXH64 of its `width`-word shingles (fewer words: one of all of
them; none: the empty set). Texts are alike when their sets' similarity is at least 0.8; a component is one of alike
texts, equal sets included.

Candidates: sets whose fingerprints `simhash.links` links (two of 64 bits; sets of one fingerprint too), and, as most pairs at 0.8
differ in more bits than segments can be cut for, sets of which one of 32
bands of four MinHash values agrees. A pair at 0.8 agrees in none with a
probability of (1 - 0.8 ** 4) ** 32, about 5e-8, and with a smaller one above. Candidates of sizes that rule 0.8 out
are left out, the others are verified on their whole sets, so nothing is linked that isn't alike.

Bands that more than `hot` different sets share are not paired; their sets are joined exactly instead. Shingles are put in one order for all
of them, rare ones first (by counts in `BUCKETS` buckets; any order is exact). Sets of n shingles that are alike share at least 0.8 n, so they share one
of the first n - ceil(0.8 n) + 1. Sets that share one of those that few sets have are paired. A pair that shares only such as many have, as in a
large group of near copies, is of two `dense` sets and shares a crowded band. These are first compared with `pivots` sets of each band, which puts most of a
group into one component; then all dense sets of a band that are in different components still are compared, in blocks of `BLOCK` sets (`_rest`). So no pair is
lost whose band is crowded. Blocks cost the square of what a band holds outside its large components, and the product of that and those components.

Defined cases: null text = empty text; all texts without words are alike; rows with null ids come last, so one stays only
if no row of its component has an id; of rows of one id that are alike, one stays; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import scratch
from . import common, simhash
from .components import components

WIDTH, BANDS, ROWS, SEED, HOT, PIVOTS = 5, 32, 4, 42, 64, 8
#: Sets that a shingle is paired for at most; sets of a block and their shingles; buckets of shingles, as bits; shingles compared at once.
FEW, BLOCK, BLOCK_SHINGLES, BUCKETS, COLUMNS = 8, 256, 500_000, 17, 2048

_RANDOM = np.random.default_rng(SEED)
_TIMES = _RANDOM.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS = _RANDOM.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_CHUNK = 4096


def digests(text: bytes, width: int = WIDTH) -> bytes:
    """The shingles' hashes in order, of eight bytes each, the most significant first."""
    words = text.lower().split()  # on bytes: both are ASCII only
    if not words:
        return b""
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_digest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    digest = xxhash.xxh64_digest
    return b"".join([digest(joined[a:b], SEED) for a, b in zip((ends - lengths).tolist(), ends[width - 1 :].tolist())])


def shingles(text: bytes, width: int = WIDTH) -> np.ndarray:
    """The sorted different shingle hashes of a UTF-8 text."""
    return np.unique(np.frombuffer(digests(text, width), ">u8").astype(np.uint64))


def bands(found: np.ndarray) -> list[int]:
    """The hash of each band's MinHash values, signed; none for the empty set."""
    if not len(found):
        return []
    high = (found >> np.uint64(32)).astype(np.uint32)[:, None]
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(high), _CHUNK):
        least = np.minimum(least, (high[at : at + _CHUNK] * _TIMES + _PLUS).min(axis=0))
    data = least.tobytes()
    size = 4 * ROWS
    keys = [xxhash.xxh64_intdigest(data[size * i : size * (i + 1)], i) for i in range(BANDS)]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def _signed(batches):
    for batch in batches:
        sets, sizes, keys, prints = [], [], [], []
        for text in batch.column(2).cast(pa.binary()).to_pylist():
            each = digests(text or b"")
            found = np.unique(np.frombuffer(each, ">u8").astype(np.uint64))
            sets.append(xxhash.xxh3_128_digest(found.tobytes()))
            sizes.append(len(found))
            keys.append(bands(found))
            prints.append(simhash.majority(np.frombuffer(each, np.uint8).reshape(-1, 8)) if each else 0)
        kinds = pa.binary(), pa.int64(), pa.list_(pa.int64())
        columns = [pa.array(x, k) for x, k in zip((sets, sizes, keys), kinds)] + [pa.array(np.array(prints, np.uint64).view(np.int64), pa.int64())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["row", "id", "set", "n", "bands", "fp"])


def _sets(batches):
    for batch in batches:
        found = [shingles(t or b"").view(np.int64) for t in batch.column(1).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["set", "shingles"])


def _sized(x: str, y: str):
    """Whether sets of these sizes can be alike."""
    return (F.col(x) * 5 >= F.col(y) * 4) & (F.col(y) * 5 >= F.col(x) * 4)


def _shared(keyed: DataFrame, hot: int) -> tuple[DataFrame, DataFrame]:
    """(pairs of sets of a key that 2 to hot sets share, rows of the keys that more share). keyed: (set, n, key)."""
    sizes = common.materialize(keyed.groupBy("key").count().where("count > 1"), "band-sizes")
    near = common.materialize(keyed.join(sizes.hint("merge"), "key"), "bands")
    paired = near.where(F.col("count") <= hot)
    left = paired.select("key", F.col("set").alias("u"), F.col("n").alias("nu"))
    right = paired.select("key", F.col("set").alias("v"), F.col("n").alias("nv"))
    found = left.join(right.hint("merge"), "key").where(F.col("u") < F.col("v")).where(_sized("nu", "nv")).select("u", "v")
    return found, near.where(F.col("count") > hot).select("key", "set", "n")


def candidates(sets: DataFrame, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(u, v) pairs to verify, and (key, set, n) of the bands that more than hot sets share. sets: distinct (set, n, bands, fp)."""
    point = scratch.mark()
    prints = common.materialize(sets.groupBy("fp").agg(F.min("set").alias("rep")), "fingerprints")
    linked = common.materialize(simhash.links(prints.select("fp")), "fingerprint-links")
    rep = lambda c: prints.select(F.col("fp").alias(c), F.col("rep").alias(f"{c}_rep")).hint("merge")
    linked = linked.join(rep("u"), "u").join(rep("v"), "v").select("u_rep", "v_rep")
    linked = linked.unionByName(common.skew_join(sets.select("fp", "set"), prints, ["fp"]).where("set <> rep").select(F.col("set").alias("u_rep"), F.col("rep").alias("v_rep")))
    linked = linked.select(F.least("u_rep", "v_rep").alias("u"), F.greatest("u_rep", "v_rep").alias("v"))

    found, crowded = _shared(sets.select("set", "n", F.explode("bands").alias("key")), hot)
    crowded = common.materialize(crowded, "crowded-bands")
    out = common.materialize(found.unionByName(linked).distinct(), "near-candidates")
    scratch.discard_since(sets.sparkSession, point, out, crowded)  # bands and keys are many times the pairs
    return out, crowded


def _buckets(found: np.ndarray) -> np.ndarray:
    return (found.view(np.uint64) >> np.uint64(64 - BUCKETS)).astype(np.int64)


def _bucket_counts(batches):
    """(bucket, n) of the buckets that a task's sets have: merged within the task, at most 2 ** BUCKETS rows."""
    counts = np.zeros(1 << BUCKETS, np.int64)
    for batch in batches:
        found = batch.column(0).flatten().to_numpy(zero_copy_only=False)
        counts += np.bincount(_buckets(found), minlength=len(counts))
    (used,) = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])


def _first(shared):
    """The shingles of each set of which alike sets share one."""

    def run(batches):
        counts = np.frombuffer(shared.value, np.int64)
        for batch in batches:
            out = []
            for found in batch.column(1):
                found = found.values.to_numpy(zero_copy_only=False)
                out.append(found[np.lexsort((found, counts[_buckets(found)]))[: len(found) - (4 * len(found) + 4) // 5 + 1]])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64()))], ["set", "first"])

    return run


def _prefixed(crowded: DataFrame, known: DataFrame, hot: int) -> tuple[DataFrame, DataFrame]:
    """(pairs of sets that share a first shingle of few sets, the dense sets' rows of crowded). known: (set, shingles)."""
    spark, point = known.sparkSession, scratch.mark()
    held = common.materialize(known.join(crowded.select("set").distinct().hint("merge"), "set", "left_semi"), "crowded-sets")
    table = held.select("shingles").mapInArrow(_bucket_counts, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # 2 ** BUCKETS rows at most
    counts = np.zeros(1 << BUCKETS, np.int64)
    counts[table["bucket"].to_numpy()] = table["n"].to_numpy()
    shared = spark.sparkContext.broadcast(counts.tobytes())
    first = held.mapInArrow(_first(shared), "set binary, first array<long>")
    first = common.materialize(first.join(crowded.select("set", "n").distinct().hint("merge"), "set").select("set", "n", F.explode("first").alias("key")), "first-shingles")
    paired, dense = _shared(first, min(hot, FEW))
    paired = common.materialize(paired.distinct(), "first-pairs")
    dense = crowded.join(dense.select("set").distinct().hint("merge"), "set", "left_semi").select("key", "set", "n")
    dense = common.materialize(dense, "dense-bands")
    scratch.discard_since(spark, point, paired, dense)
    return paired, dense


def _pivoted(dense: DataFrame, pivots: int) -> DataFrame:
    """(u, v): each set of a band and the band's pivots, in the same order in every band, so that bands of one group have the same ones."""
    rows = dense.select("key", F.col("set").alias("v"), F.col("n").alias("nv"))
    least = rows.groupBy("key", F.pmod(F.xxhash64("v"), F.lit(pivots)).alias("of")).agg(F.min(F.struct("v", "nv")).alias("p"))
    least = least.select("key", F.col("p.v").alias("u"), F.col("p.nv").alias("nu"))
    met = common.skew_join(rows, least, ["key"]).where(F.col("u") != F.col("v")).where(_sized("nu", "nv"))
    return met.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def alike_roots(table: pa.Table) -> pa.Table:
    """(u, v): different roots that alike sets of the two sides have. table: (unit, other, root, shingles); of one side only: within it."""
    table = table.combine_chunks()
    names, roots = np.unique(np.array(table["root"].to_pylist(), object), return_inverse=True)
    sizes = table["shingles"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    other = table["other"].to_numpy().astype(bool)
    a, b = np.flatnonzero(~other), np.flatnonzero(other)
    b = b if len(b) else a
    column = np.unique(table["shingles"].combine_chunks().flatten().to_numpy(zero_copy_only=False), return_inverse=True)[1]
    row = np.repeat(np.arange(len(sizes)), sizes)
    within = [np.bincount(column[other[row] == side]) for side in (False, True)]
    width = max(map(len, within))
    within = [np.pad(w, (0, width - len(w))) for w in within]
    both = (within[0] > 0) & (within[1] > 0) if other.any() else within[0] > 1
    row, column = row[both[column]], (np.cumsum(both) - 1)[column[both[column]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common_ = np.zeros((len(a), len(b)), np.float32)  # whole numbers below 2 ** 24
    for at in range(0, int(both.sum()), COLUMNS):
        lo, hi = np.searchsorted(column, (at, at + COLUMNS))
        held = np.zeros((len(sizes), COLUMNS), np.float32)
        held[row[lo:hi], column[lo:hi] - at] = 1
        common_ += held[a] @ held[b].T
    alike = common_.astype(np.int64) * 9 >= (sizes[a][:, None] + sizes[b][None, :]) * 4
    u, v = np.nonzero(alike & (roots[a][:, None] != roots[b][None, :]))
    u, v = roots[a][u], roots[b][v]
    codes = np.unique(np.minimum(u, v) * len(names) + np.maximum(u, v))
    pick = lambda x: pa.array(names[x].tolist(), pa.binary())
    return pa.table([pick(codes // max(1, len(names))), pick(codes % max(1, len(names)))], names=["u", "v"])


def _rest(dense: DataFrame, known: DataFrame, roots: DataFrame, block: int = BLOCK) -> DataFrame:
    """roots, after the dense sets of each band that are in different components were compared.

    A component of more than a block is compared as a whole with the sets that share a band with it, once whatever the number of
    bands; sets of smaller ones are compared band by band. dense: (key, set, n); known: (set, shingles); roots: (u, root).
    """
    if dense.isEmpty():
        return roots
    point = scratch.mark()
    rooted = dense.join(roots.withColumnRenamed("u", "set").hint("merge"), "set", "left").select("key", "set", "n", F.coalesce("root", "set").alias("root"))
    rooted = common.materialize(rooted, "dense-roots")
    several = rooted.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("key")
    rooted = common.materialize(common.skew_join(rooted, several, ["key"]), "several-roots")
    if rooted.isEmpty():
        return roots
    blocks = F.ceil(F.greatest(F.count("*") / F.lit(block), F.sum("n") / F.lit(BLOCK_SHINGLES))).cast("int").alias("blocks")
    large = rooted.select("root", "set", "n").distinct().groupBy("root").agg(blocks).where("blocks > 1").select("root")
    large = common.materialize(large, "large-roots")
    inside = rooted.join(large.hint("merge"), "root", "left_semi")
    loose = common.materialize(rooted.join(large.hint("merge"), "root", "left_anti"), "loose-sets")
    homes = common.materialize(inside.select("key", F.col("root").alias("home")).distinct(), "homes")
    of = lambda rows, kind, name: rows.select(F.lit(kind).alias("kind"), F.hex(name).alias("name"), "set", "n", "root").distinct()
    grouped = of(inside, "large", "root").unionByName(of(common.skew_join(loose, homes, ["key"]), "guests", "home")).unionByName(of(loose, "band", "key"))
    grouped = common.materialize(grouped, "groups")
    counts = grouped.groupBy("kind", "name").agg(blocks, F.min("root").alias("a"), F.max("root").alias("b")).where("kind <> 'band' or a <> b")
    counts = common.materialize(counts.select("kind", "name", "blocks"), "group-blocks")
    dealt = common.skew_join(grouped, counts, ["kind", "name"]).select("kind", "name", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int").alias("block"), "set", "root")
    dealt = common.materialize(dealt, "blocks")

    each = lambda kind, name, number: counts.where(F.col("kind") == kind).select(F.col("name").alias(name), F.col("blocks").alias(number))
    home = lambda c: homes.select("key", F.hex("home").alias(c))
    met = home("a").join(home("b").hint("merge"), "key").where("a < b").select("a", "b").distinct()
    pairs = [
        each("band", "a", "na").select(F.lit("band").alias("ka"), "a", "na", F.lit("band").alias("kb"), F.col("a").alias("b"), F.col("na").alias("nb")),
        each("large", "a", "na").join(each("guests", "a", "nb").hint("merge"), "a").select(F.lit("large").alias("ka"), "a", "na", F.lit("guests").alias("kb"), F.col("a").alias("b"), "nb"),
        met.join(each("large", "a", "na").hint("merge"), "a").join(each("large", "b", "nb").hint("merge"), "b").select(F.lit("large").alias("ka"), "a", "na", F.lit("large").alias("kb"), "b", "nb"),
    ]
    units = pairs[0].unionByName(pairs[1]).unionByName(pairs[2])
    units = units.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("na") - 1))).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).where("ka <> 'band' or i <= j")
    units = common.materialize(units.repartition("a", "b", "i", "j").withColumn("unit", F.monotonically_increasing_id()), "units")
    left = units.select("unit", F.col("ka").alias("kind"), F.col("a").alias("name"), F.col("i").alias("block"), F.lit(False).alias("other"))
    right = units.where("ka <> 'band' or i <> j").select("unit", F.col("kb").alias("kind"), F.col("b").alias("name"), F.col("j").alias("block"), F.lit(True).alias("other"))
    laid = common.materialize(left.unionByName(right).join(dealt.hint("merge"), ["kind", "name", "block"]).select("unit", "other", "set", "root"), "laid-blocks")
    whole = common.skew_join(laid, known, ["set"], salts=16).select("unit", "other", "root", "shingles")
    more = common.materialize(whole.groupBy("unit").applyInArrow(alike_roots, "u binary, v binary").distinct(), "rest-links")
    scratch.discard_since(dense.sparkSession, point, more)
    if more.isEmpty():
        return roots
    return components(roots.select("u", F.col("root").alias("v")).unionByName(more))


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """Of the rows of a component, the one with the smallest id stays, by a written row number; columns as they came."""
    common.bound_batches(df.sparkSession)
    held = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("held"), F.monotonically_increasing_id().alias("row"))
    held = common.materialize(held, "numbered")
    id_, text = F.col(f"held.`{id_col}`"), F.col(f"held.`{text_col}`").cast("string")
    rows = held.select("row", id_.alias("id"), text.alias("text"))
    signed = rows.mapInArrow(_signed, f"row long, id {dict(rows.dtypes)['id']}, set binary, n long, bands array<long>, fp long")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    sets = signed.groupBy("set").agg(F.min(place).alias("least"), F.any_value("n").alias("n"), F.any_value("bands").alias("bands"), F.any_value("fp").alias("fp"))
    sets = common.materialize(sets, "shingle-sets")

    pairs, crowded = candidates(sets.select("set", "n", "bands", "fp"), hot)
    needed = pairs.select(F.col("u").alias("set")).unionByName(pairs.select(F.col("v").alias("set"))).unionByName(crowded.select("set")).distinct()
    needed = sets.select("set", "least.row").join(needed.hint("merge"), "set", "left_semi")
    texts = held.select("row", text.alias("text")).join(needed.hint("merge"), "row").select("set", "text")
    known = common.materialize(texts.mapInArrow(_sets, "set binary, shingles array<long>"), "candidate-sets")
    any_crowded = not crowded.isEmpty()  # else there is nothing to do for them
    if any_crowded:
        first, dense = _prefixed(crowded, known, hot)
        before, pairs = pairs, common.materialize(pairs.unionByName(first).unionByName(_pivoted(dense, pivots)).distinct(), "near-pairs")
        for done in (before, first, crowded):
            common.discard(done)
    # a pivot can be in very many pairs
    own = lambda c, name: common.skew_join(pairs, known.select(F.col("set").alias(c), F.col("shingles").alias(name)), [c], salts=16)
    both = own("u", "a").join(own("v", "b").hint("merge"), ["u", "v"])
    # in both / in either >= 0.8
    alike = both.where(F.size(F.array_intersect("a", "b")) * 9 >= (F.size("a") + F.size("b")) * 4).select("u", "v")

    roots = components(alike)
    common.discard(pairs)
    if any_crowded:
        roots = _rest(dense, known, roots, block)
    rooted = sets.select("set", "least").join(roots.withColumnRenamed("u", "set").hint("merge"), "set", "left")
    stays = rooted.groupBy(F.coalesce("root", "set").alias("root")).agg(F.min("least").alias("stays"))
    return held.join(stays.select("stays.row").hint("merge"), "row", "left_semi").select("held.*")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents alike at 0.8 of their five-word shingles, the one with the smallest id stays; columns as they came.

    A document without an id stays unless a copy stays.
    """
    return near_dedup(docs)
