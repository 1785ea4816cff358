"""Benchmark decontamination by spaced-seed hashing.

Texts are lower-cased and read as words (runs of letters and digits). A seed is a mask over a window of words; places of 0 are
ignored, so words can differ there. Benchmark windows give a table of (hash, item, place), and windows of documents that
have one of its hashes are hits. An item's masks go by its length (`FAMILIES`): items of 5 to 19 words have a hit
wherever `share` of their words agree, whichever differ, longer ones nearly always (tests measure it). Items of fewer than five words are
one window, as no word of them may differ.

Around hits the item is laid over the document and the words that agree are counted. Hits whose offsets are at most `SHIFT`
apart are one overlap, so a word put in or left out doesn't end it. The document holds the item if at least `share` of the words
of a stretch of `STRETCH` item words (of the whole item, if it has no more) agree.

The join: test hashes of up to `broadcast_seeds` rows are broadcast, after they were counted, and documents are read in one
pass without a shuffle. A larger table is joined: windows that pass a filter of fixed size (two bit tables of the test hashes) are
rows, joined with the test hashes on the hash, salted, and verified; also one pass, with the same rows as result.

Defined cases: null or wordless texts hold nothing, and such items are in nothing; item ids are of any type, null included; items
of one id are listed each; repeated rows get a row each; an empty table gives an empty table; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import common

#: (least words of an item, masks); the first that an item has the words for is its family.
FAMILIES = (
    (20, ("111111", "1101100101", "101001111")),
    (10, ("111101", "10011101", "10100111")),
    (5, ("1111", "10111", "11011", "11101")),
)
SHARE, STRETCH, SHIFT, BROADCAST_SEEDS = 0.8, 60, 4, 2_000_000
WORD = re.compile(r"[^\W_]+")
#: Hashes of words that a worker remembers.
REMEMBERED = 500_000
#: Bits of one table of a filter.
TABLE_BITS, FILTER_BITS = 22, 26


class WordHashes:
    """64-bit hashes of a text's words, in order."""

    def __init__(self):
        self.known: dict[str, bytes] = {}

    def __call__(self, text: str) -> np.ndarray:
        words, known = WORD.findall(text.lower()), self.known
        try:
            packed = b"".join(map(known.__getitem__, words))
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for word in set(words).difference(known):
                known[word] = xxhash.xxh64_intdigest(word.encode(), 11).to_bytes(8, "little")
            packed = b"".join(map(known.__getitem__, words))
        return np.frombuffer(packed, np.uint64)


def masks_of(length: int) -> tuple[str, ...]:
    """The masks of an item of so many words."""
    return next((masks for least, masks in FAMILIES if length >= least), ("1" * length,) if length else ())


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """The hash of each window under the mask; the mask is part of it."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.full(n, xxhash.xxh64_intdigest(mask.encode(), 5), np.uint64)
        for i, c in enumerate(mask):
            if c == "1":  # an odd factor for each place
                total += words[i : i + n] * np.uint64(xxhash.xxh64_intdigest(b"%d" % i, 3) | 1)
        total ^= total >> np.uint64(32)
        total *= np.uint64(0x9E3779B97F4A7C15)
        return total ^ (total >> np.uint64(29))


def overlap(words: np.ndarray, item: np.ndarray, offsets: list[int]) -> float:
    """The largest share of a stretch of the item that agrees with the words around the hits' offsets."""
    stretch, best = min(len(item), STRETCH), 0.0
    agree, last = None, None

    def most(agree: np.ndarray) -> float:
        sums = np.concatenate(([0], np.cumsum(agree)))
        return float((sums[stretch:] - sums[:-stretch]).max() / stretch)

    for offset in sorted(offsets):
        if last is None or offset - last > SHIFT:
            best = max(best, most(agree)) if agree is not None else best
            agree = np.zeros(len(item), bool)
        lo, hi = max(0, -offset), min(len(item), len(words) - offset)
        if hi > lo:
            agree[lo:hi] |= words[offset + lo : offset + hi] == item[lo:hi]
        last = offset
    return max(best, most(agree)) if agree is not None else best


# The tables of the benchmark


def _item_words(batches):
    hashes = WordHashes()
    for batch in batches:
        words = [hashes(t or "").tobytes() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.binary())], ["id", "words"])


def _item_seeds(batches):
    for batch in batches:
        for item, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = np.frombuffer(packed, np.uint64)
            for mask in masks_of(len(words)):
                found = seeds(words, mask)
                columns = [pa.array(found.view(np.int64)), pa.array(np.full(len(found), item, np.int64)), pa.array(np.arange(len(found), dtype=np.int32)), pa.array([mask] * len(found), pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["h", "item", "place", "mask"])


def test_tables(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(item: number, id, words) and (h, item, place, mask), written."""
    rows = benchmark.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    words = rows.mapInArrow(_item_words, f"id {kind}, words binary").where(F.length("words") > 0)
    items = common.materialize(words.withColumn("item", F.monotonically_increasing_id()), "benchmark-items")
    found = items.select("item", "words").mapInArrow(_item_seeds, "h long, item long, place int, mask string")
    return items, common.materialize(found, "benchmark-seeds")


class TestSet:
    """The test hashes as arrays: for a benchmark that was counted to be small."""

    def __init__(self, items, found):
        """items: (item, id, words); found: (h, item, place, mask), both as Arrow tables."""
        numbers = {n: k for k, n in enumerate(items["item"].to_pylist())}
        self.ids = items["id"].to_pylist()
        self.words = [np.frombuffer(w, np.uint64) for w in items["words"].to_pylist()]
        h, place = found["h"].to_numpy().view(np.uint64), found["place"].to_numpy()
        item = np.array([numbers[n] for n in found["item"].to_pylist()], np.int64)
        mask = np.array(found["mask"].to_pylist(), object)
        self.tables = []
        for m in sorted(set(mask.tolist())):
            own = np.flatnonzero(mask == m)
            own = own[np.argsort(h[own], kind="stable")]
            bits = np.zeros(1 << TABLE_BITS, bool)
            bits[(h[own] >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
            self.tables.append((m, h[own], item[own], place[own], bits))

    def overlaps(self, words: np.ndarray, share: float) -> list[tuple[int, float]]:
        """(item number, share that agrees) of the items that the document holds."""
        hits: dict[int, set[int]] = {}
        for mask, keys, item, place, bits in self.tables:
            found = seeds(words, mask)
            near = np.flatnonzero(bits[(found >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
            first = np.searchsorted(keys, found[near])
            behind = np.searchsorted(keys, found[near], "right")
            for at, lo, hi in zip(near[behind > first].tolist(), first[behind > first].tolist(), behind[behind > first].tolist()):
                for k, p in zip(item[lo:hi].tolist(), place[lo:hi].tolist()):
                    hits.setdefault(k, set()).add(at - p)
        told = ((k, overlap(words, self.words[k], list(offsets))) for k, offsets in sorted(hits.items()))
        return [(k, most) for k, most in told if most >= share]


def _scan(tests, share: float, id_type: pa.DataType):
    def run(batches):
        known, hashes = tests.value, WordHashes()
        for batch in batches:
            found = [known.overlaps(hashes(t), share) if t else [] for t in batch.column(1).to_pylist()]
            held = pa.array([[known.ids[k] for k, _ in f] for f in found], pa.list_(id_type))
            yield pa.RecordBatch.from_arrays([batch.column(0), held, pa.array([max((m for _, m in f), default=0.0) for f in found], pa.float64())], ["held", "items", "most"])

    return run


# Test hashes that are too many to broadcast


def _bit_tables(bits: int):
    def run(batches):
        tables = np.zeros((2, 1 << (bits - 3)), np.uint8)
        for batch in batches:
            _mark(tables, batch.column(0).to_numpy().view(np.uint64), bits)
        yield pa.RecordBatch.from_arrays([pa.array([tables.tobytes()], pa.binary())], ["tables"])

    return run


def _places(h: np.ndarray, bits: int):
    yield (h >> np.uint64(64 - bits)).astype(np.int64)
    yield (h & np.uint64((1 << bits) - 1)).astype(np.int64)


def _mark(tables: np.ndarray, h: np.ndarray, bits: int) -> None:
    for table, at in zip(tables, _places(h, bits)):
        np.bitwise_or.at(table, at >> 3, (1 << (at & 7)).astype(np.uint8))


def _passes(tables: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    near = np.arange(len(h))
    for table, which in zip(tables, (0, 1)):
        at = list(_places(h[near], bits))[which]
        near = near[(table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
    return near


def _windows(shared, masks: list[str], bits: int):
    def run(batches):
        tables, hashes = np.frombuffer(shared.value, np.uint8).reshape(2, -1), WordHashes()
        for batch in batches:
            packed, hits = [], []
            for text in batch.column(1).to_pylist():
                words, own = hashes(text or ""), []
                for number, mask in enumerate(masks):
                    found = seeds(words, mask)
                    near = _passes(tables, found, bits)
                    own += [{"h": h, "at": at, "m": number} for h, at in zip(found[near].view(np.int64).tolist(), near.tolist())]
                hits.append(own)
                packed.append(words.tobytes() if own else None)
            kind = pa.list_(pa.struct([("h", pa.int64()), ("at", pa.int32()), ("m", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary()), pa.array(hits, kind)], ["held", "words", "hits"])

    return run


def _verify(batches):
    for batch in batches:
        own, item, offsets = (batch.column(i).to_pylist() for i in (2, 3, 4))
        most = [overlap(np.frombuffer(w, np.uint64), np.frombuffer(x, np.uint64), o) for w, x, o in zip(own, item, offsets)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(most, pa.float64())], ["row", "item", "most"])


def _joined(rows: DataFrame, items: DataFrame, tests: DataFrame, share: float) -> DataFrame:
    """What `_scan` gives, by joins on hashes. rows: (held, text)."""
    spark = rows.sparkSession
    tables = np.zeros(2 << (FILTER_BITS - 3), np.uint8)
    for part in tests.select("h").mapInArrow(_bit_tables(FILTER_BITS), "tables binary").toLocalIterator():
        tables |= np.frombuffer(part.tables, np.uint8)
    masks = sorted({m for least, family in FAMILIES for m in family} | {"1" * k for k in range(1, FAMILIES[-1][0])})
    shared = spark.sparkContext.broadcast(tables.tobytes())  # of a fixed size
    kind = rows.schema["held"].dataType.simpleString()
    windows = rows.mapInArrow(_windows(shared, masks, FILTER_BITS), f"held {kind}, words binary, hits array<struct<h:long,at:int,m:int>>")
    windows = common.materialize(windows.withColumn("row", F.monotonically_increasing_id()), "decontamination-windows")
    hits = windows.select("row", F.explode("hits").alias("x")).select("row", "x.h", "x.at", F.get(F.array(*map(F.lit, masks)), F.col("x.m")).alias("mask"))
    met = common.skew_join(hits, tests, ["h", "mask"]).select("row", "item", (F.col("at") - F.col("place")).alias("offset"))
    offsets = met.groupBy("row", "item").agg(F.collect_set("offset").alias("offsets"))
    laid = common.skew_join(offsets, items.select("item", F.col("words").alias("own")), ["item"])
    laid = laid.join(windows.select("row", "words").hint("merge"), "row").select("row", "item", "words", "own", "offsets")
    told = laid.mapInArrow(_verify, "row long, item long, most double").where(F.col("most") >= share)
    held = common.skew_join(told, items.select("item", "id"), ["item"]).groupBy("row").agg(F.collect_list(F.struct("id")).alias("ids"), F.max("most").alias("most"))
    out = windows.select("row", "held").join(held.hint("merge"), "row", "left")
    none = F.array().cast(f"array<{items.schema['id'].dataType.simpleString()}>")
    return out.select("held", F.coalesce(F.transform("ids", lambda x: x["id"]), none).alias("items"), F.coalesce("most", F.lit(0.0)).alias("most"))


def contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, text_col: str = "text", share: float = SHARE, broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """(held, items, most) of every row: its columns `keep` (default: all), the item ids it holds, ascending, and its largest overlap (0 if it holds none)."""
    spark = docs.sparkSession
    common.bound_batches(spark)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("held"), F.col(f"`{text_col}`").cast("string").alias("text"))
    items, tests = test_tables(benchmark)
    if tests.count() <= broadcast_seeds:
        known = spark.sparkContext.broadcast(TestSet(items.toArrow(), tests.toArrow()))
        id_type = items.schema["id"].dataType
        kinds = rows.schema["held"].dataType.simpleString(), id_type.simpleString()
        out = rows.mapInArrow(_scan(known, share, to_arrow_type(id_type)), f"held {kinds[0]}, items array<{kinds[1]}>, most double")
    else:
        out = _joined(rows, items, tests, share)
    return out.select("held", F.array_sort("items").alias("items"), "most")


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    docs, benchmark = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark")
    rows = contamination(docs, benchmark, ["doc_id"])
    return rows.select("held.doc_id", (F.size("items") > 0).alias("contaminated"), F.array_join("items", ",").alias("items"), F.col("most").alias("overlap"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, columns as they came."""
    return contamination(docs, common.table(spark, sf_dir, "benchmark")).where(F.size("items") == 0).select("held.*")


def _oracle() -> str:
    """The same in DuckDB: seeds are the words themselves."""
    family = " ".join(f"WHEN length(ws) >= {least} THEN {list(masks)}" for least, masks in FAMILIES)
    every = sorted({m for _, masks in FAMILIES for m in masks} | {"1" * k for k in range(1, FAMILIES[-1][0])})
    words = lambda c: f"regexp_extract_all(lower(coalesce({c}, '')), '[\\pL\\pN]+')"
    seed = "mask || ' ' || array_to_string([ws[p + z] FOR z IN range(1, length(mask) + 1) IF mask[z] = '1'], ' ')"
    return f"""
WITH items AS (SELECT row_number() OVER () AS ik, item_id, {words("text")} AS ws FROM benchmark),
docs AS (SELECT row_number() OVER () AS rk, doc_id, {words("text")} AS ws FROM documents),
im AS (SELECT *, unnest(CASE {family} WHEN length(ws) > 0 THEN [repeat('1', length(ws))] ELSE [] END) AS mask FROM items),
iw AS (SELECT *, unnest(range(0, length(ws) - length(mask) + 1)) AS p FROM im),
test AS (SELECT ik, p, {seed} AS seed FROM iw),
dw AS (SELECT rk, ws, mask, unnest(range(0, length(ws) - length(mask) + 1)) AS p FROM docs, (SELECT unnest({every}) AS mask) WHERE mask IN (SELECT mask FROM im)),
hits AS (SELECT DISTINCT rk, ik, dw.p - test.p AS o FROM (SELECT rk, p, {seed} AS seed FROM dw) dw JOIN test USING (seed)),
gaps AS (SELECT *, CASE WHEN o - lag(o) OVER (PARTITION BY rk, ik ORDER BY o) <= {SHIFT} THEN 0 ELSE 1 END AS new FROM hits),
laid AS (SELECT rk, ik, o, sum(new) OVER (PARTITION BY rk, ik ORDER BY o) AS c FROM gaps),
agree AS (SELECT rk, ik, c, j, max(CASE WHEN o + j >= 1 AND d.ws[o + j] = i.ws[j] THEN 1 ELSE 0 END) AS a, any_value(least(length(i.ws), {STRETCH})) AS stretch
          FROM (SELECT laid.*, unnest(range(1, length(items.ws) + 1)) AS j FROM laid JOIN items USING (ik)) l JOIN docs d USING (rk) JOIN items i USING (ik) GROUP BY rk, ik, c, j),
cum AS (SELECT *, sum(a) OVER w AS s FROM agree WINDOW w AS (PARTITION BY rk, ik, c ORDER BY j)),
run AS (SELECT rk, ik, j, stretch, s - coalesce(lag(s, {STRETCH}) OVER (PARTITION BY rk, ik, c ORDER BY j), 0) AS n FROM cum),
most AS (SELECT rk, ik, max(n)::DOUBLE / any_value(stretch) AS most FROM run WHERE j >= stretch GROUP BY rk, ik HAVING most >= {SHARE}),
held AS (SELECT rk, string_agg(item_id::VARCHAR, ',' ORDER BY item_id) AS items, max(most) AS most FROM most JOIN items USING (ik) GROUP BY rk)
SELECT doc_id, held.rk IS NOT NULL AS contaminated, coalesce(items, '') AS items, coalesce(most, 0)::DOUBLE AS overlap FROM docs LEFT JOIN held USING (rk)
"""


SQL = {"op9_decontamination": _oracle()}
