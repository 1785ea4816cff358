"""Ranked lexical search by the threshold algorithm.

Terms are the runs of letters and digits (everything over ASCII is one) of a whole text with A-Z lower-cased. The index is dealt
by a hash of the document's row into shards of about `SHARD` postings. A task has one shard and one block of items:

* an impact-sorted list for each term: the documents with the highest term impact first;
* a forward index: a document's terms and impacts together.

For an item the task reads its terms' lists round-robin, `FIRST` places of each list in the first round and twice as many in each
next one. A document that is seen for the first time is scored at once by a random look-up in the forward index. The
threshold is the sum of the impacts where the lists stand: no unseen document can have more. The task stops when the threshold is strictly
under its kth score (an equal one could still win by its id) or the lists are at an end. A shard's k best of an item are a few rows; the
best of all shards are the best of all, so the result is exact.

Texts are read once, and only as many of their terms are shuffled as stand in items. Which those are is a join with the items'
terms, which Spark broadcasts only under its own threshold of size. Nothing is collected but the number of documents and terms.
No group is larger than a shard and a block of items, whatever a term's or a source's share.

Defined cases: null text = empty text = no terms; a document without terms is never returned and doesn't count; an item without known
terms has no rows; every row of documents and of items is one of its own, so equal ids are ranked side by side; null ids come
last among equal scores; empty tables give an empty table; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

TOP = 50
#: Postings of a shard, items of a block.
SHARD, BLOCK = 500_000, 512
#: Places of each list that the first round reads.
FIRST = 16
#: Bytes of a text that are cut into terms at a time.
PIECE = 1 << 20

#: The complement of the ASCII characters that are neither letters nor digits, on lower-cased UTF-8 bytes.
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: The posting that every document has: its number of terms. No term is empty.
LENGTH = b""


def counted(text: bytes | None) -> Counter:
    """term -> how often it occurs, and LENGTH -> all occurrences."""
    found, at, text = Counter(), 0, (text or b"").lower()
    while at < len(text):
        end = at + PIECE
        if end < len(text) and (rest := TERM.match(text, end)):
            end = rest.end()  # a term that the cut would part goes with this piece
        found.update(TERM.findall(text, at, end))
        at = end
    found[LENGTH] = found.total()
    return found


def _postings(batches):
    for batch in batches:
        each = [counted(t) for t in batch.column(1).to_pylist()]
        sizes = pa.array(np.cumsum([0, *map(len, each)]), pa.int32())
        terms = pa.array([t for x in each for t in x], pa.binary()).cast(pa.string())
        times = pa.array([n for x in each for n in x.values()], pa.int64())
        both = pa.ListArray.from_arrays(sizes, pa.StructArray.from_arrays([terms, times], ["term", "tf"]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[LENGTH] for x in each], pa.int64()), both], ["id", "n", "terms"])


def postings(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, n, term, tf) of every term of every text, and a row with the empty term for each text."""
    common.bound_batches(df.sparkSession)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    found = rows.mapInArrow(_postings, f"id {dict(rows.dtypes)['id']}, n long, terms array<struct<term:string,tf:long>>")
    return found.withColumn("row", F.monotonically_increasing_id()).select("row", "id", "n", F.explode("terms").alias("x")).select("row", "id", "n", "x.term", "x.tf")


class Shard:
    """The impact-sorted lists and the forward index of some documents; documents are numbered by id, then row."""

    def __init__(self, rows: pa.Table):
        rows = rows.take(pc.sort_indices(rows, sort_keys=[("id", "ascending"), ("row", "ascending")], null_placement="at_end"))
        row = rows["row"].to_numpy()
        begins = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, np.int64)
        self.ids, self.rows = rows["id"].combine_chunks().take(pa.array(begins)), row[begins]
        self.forward = np.r_[begins, len(row)]
        encoded = rows["term"].combine_chunks().dictionary_encode()
        self.codes = {t: c for c, t in enumerate(encoded.dictionary.to_pylist())}
        self.code, tf = encoded.indices.to_numpy(), rows["tf"].to_numpy()
        self.impact = 1_000_000_000 * tf // (1000 * tf + 20 * rows["m"].to_numpy())
        doc = np.repeat(np.arange(len(begins)), np.diff(self.forward))
        order = np.lexsort((doc, -self.impact, self.code))
        self.doc, self.sorted = doc[order], self.impact[order]
        self.lists = np.r_[0, np.cumsum(np.bincount(self.code, minlength=len(self.codes)))]

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Random look-ups: the whole score of each document."""
        sizes = self.forward[docs + 1] - self.forward[docs]
        begins = np.r_[0, np.cumsum(sizes)[:-1]]
        at = np.arange(sizes.sum()) + np.repeat(self.forward[docs] - begins, sizes)
        return np.add.reduceat(weights[self.code[at]] * self.impact[at], begins)

    def best(self, terms: list[tuple[str, int]], k: int, first: int = FIRST) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores) of the k best, highest first, ties by number; and how many documents were looked up."""
        weights, lists = np.zeros(len(self.codes), np.int64), []
        for term, w in terms:
            if w > 0 and term in self.codes:
                c = self.codes[term]
                weights[c] = w
                lists.append((w, self.lists[c], self.lists[c + 1]))
        docs, scores, seen = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(self.rows), bool)
        depth, step = 0, first
        while lists:
            depth, was, step = depth + step, depth, step * 2
            new = np.unique(np.concatenate([self.doc[a + was : min(a + depth, b)] for _, a, b in lists]))
            new = new[~seen[new]]
            if len(new):
                seen[new] = True
                docs, scores = np.r_[docs, new], np.r_[scores, self.scores(new, weights)]
                best = np.lexsort((docs, -scores))[:k]
                docs, scores = docs[best], scores[best]
            lists = [x for x in lists if x[1] + depth < x[2]]
            threshold = sum(w * int(self.sorted[a + depth - 1]) for w, a, _ in lists)
            if len(docs) == k and threshold < scores[-1]:
                break
        return docs, scores, int(seen.sum())


def _search(k: int, id_type: pa.DataType, item_type: pa.DataType):
    def run(index: pa.Table, items: pa.Table) -> pa.Table:
        found = {"item": [], "item_id": [], "row": [], "id": [], "score": []}
        if index.num_rows:
            shard = Shard(index)
            for item, item_id, terms in zip(*(items[c].to_pylist() for c in ("item", "item_id", "terms"))):
                docs, scores, _ = shard.best([(x["term"], x["w"]) for x in terms], k)
                found["item"] += [item] * len(docs)
                found["item_id"] += [item_id] * len(docs)
                found["row"] += shard.rows[docs].tolist()
                found["id"] += shard.ids.take(pa.array(docs)).to_pylist()
                found["score"] += scores.tolist()
        return pa.table({c: pa.array(v, {"id": id_type, "item_id": item_type}.get(c, pa.int64())) for c, v in found.items()})

    return run


def ranked(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", top: int = TOP, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(item_col, rank, id_col, score) of the `top` best documents of every item; see the module's docstring."""
    from pyspark.sql.pandas.types import to_arrow_type

    asked = common.materialize(postings(items, item_col, item_text_col).select(F.col("row").alias("item"), F.col("id").alias("item_id"), "term"), "lexical-items")
    index = common.materialize(postings(df, id_col, text_col).join(asked.select("term").distinct(), "term", "left_semi"), "lexical-index")
    lengths = index.where("term = ''")
    n_docs, n_terms, n_postings, n_items = (x or 0 for x in (*lengths.agg(F.count_if(F.col("n") > 0), F.sum("n")).first(), index.count(), asked.where("term = ''").count()))
    n_shards, n_blocks = max(1, -(-n_postings // shard)), max(1, -(-n_items // block))
    known = index.where("term <> ''").groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    weighted = asked.join(known, "term").groupBy("item", "item_id").agg(F.collect_list(F.struct("term", weight.alias("w"))).alias("terms"))
    weighted = weighted.select("item", "item_id", "terms", F.pmod(F.xxhash64("item"), F.lit(n_blocks)).alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long"))).alias("shard"))
    # decimals, as 50 * n * N can be more than a long holds
    m = F.expr(f"50 + CAST((CAST(n AS DECIMAL(18,0)) * {50 * n_docs}) div {max(1, n_terms)} AS LONG)")
    dealt = index.where("term <> ''").select(F.pmod(F.xxhash64("row"), F.lit(n_shards)).alias("shard"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("block"), "row", "id", "term", "tf", m.alias("m"))
    id_type, item_type = index.schema["id"].dataType, asked.schema["item_id"].dataType
    found = dealt.groupBy("shard", "block").cogroup(weighted.groupBy("shard", "block")).applyInArrow(
        _search(top, to_arrow_type(id_type), to_arrow_type(item_type)), f"item long, item_id {item_type.simpleString()}, row long, id {id_type.simpleString()}, score long"
    )
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    best = found.where("score > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.select(F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def op11_ranked_lexical(spark, sf_dir: str) -> DataFrame:
    return ranked(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


SQL = {
    "op11_ranked_lexical": rf"""
WITH w AS (SELECT row_number() OVER () AS rk, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{common.UPPER}', '{common.LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
d AS (SELECT rk, doc_id, len(terms)::BIGINT AS n, terms FROM w WHERE len(terms) > 0),
s AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM d),
p AS (SELECT rk, term, count(*)::BIGINT AS tf FROM (SELECT rk, unnest(terms) AS term FROM d) GROUP BY ALL),
i AS (SELECT item, item_id, unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''), '{common.UPPER}', '{common.LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM (SELECT row_number() OVER () AS item, * FROM benchmark)),
v AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term, docs),
m AS (SELECT rk, doc_id, 50 + (50 * n * docs) // total AS m FROM d, s),
f AS (SELECT item, item_id, rk, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score FROM i JOIN v USING (term) JOIN p USING (term) JOIN m USING (rk) GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score FROM f JOIN m USING (rk) WHERE score > 0 QUALIFY rank <= {TOP}
"""
}
