"""Exact dedup by skew-safe combining.

Documents are equal when their texts are identical after lower-casing A-Z only; a null text counts as empty.
The copies of one text are merged three times, each time comparing the full content, never the digest alone:

1. locally: before any shuffle, each task merges the equal texts of its own partition;
2. by salt: what is left of a digest is spread over `salts` tasks and merged there;
3. globally: the winners of the salts, at most `salts` of a text, are merged.

A text that a third of all rows share thus reaches the shuffle once per map task, and no task of step 2 or 3
gets more than (map tasks / salts) or `salts` rows of it. Texts are shuffled twice; the documents' rows only
as (id, digest). They get their group by joining on the digest, which stands for one text unless two texts of
equal digest were seen; that is counted, and the rows of such digests are joined on their content as well.

Defined cases: null text = empty text; null ids keep the group's largest id, or null if it has none;
repeated rows of the winning id are one document and are all kept; an empty table gives an empty table;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SALTS = 16


def _normalised(with_text: bool):
    def run(batches):
        for batch in batches:
            texts = pc.ascii_lower(pc.fill_null(batch.column(1), ""))
            digests = pa.array([hashlib.sha256(x.as_buffer() or b"").digest() for x in texts], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), digests, *([texts.cast(pa.string())] if with_text else [])],
                ["id", "digest", *(["content"] if with_text else [])],
            )

    return run


def normalised(df: DataFrame, id_col: str, text_col: str, with_text: bool) -> DataFrame:
    """(id, digest[, content]) of each row."""
    common.bound_batches(df.sparkSession)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("content"))
    id_type = dict(rows.dtypes)["id"]
    return rows.mapInArrow(_normalised(with_text), f"id {id_type}, digest binary" + ", content string" * with_text)


def groups(df: DataFrame, id_col: str, text_col: str, salts: int = SALTS) -> DataFrame:
    """(digest, content, keep_id, group_size): one row for each distinct content."""
    rows = normalised(df, id_col, text_col, True).withColumn("salt", F.spark_partition_id() % salts)
    salted = rows.groupBy("digest", "salt", "content").agg(F.max("id").alias("keep_id"), F.count("*").alias("n"))
    return salted.groupBy("digest", "content").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """(id_col, keep_id, group_size, kept, text_sha256) of every row; see the module's docstring."""
    found = common.materialize(
        groups(df, id_col, text_col, salts).select("digest", "keep_id", "group_size"),
        "exact-groups",
    )
    members = normalised(df, id_col, text_col, False)
    clashing = found.groupBy("digest").count().where("count > 1").select("digest")
    if clashing.isEmpty():
        joined = members.join(found.hint("merge"), "digest")
    else:  # two texts of one digest: their rows are told apart by content
        by_content = normalised(df, id_col, text_col, True).join(clashing, "digest", "left_semi")
        exact = groups(df, id_col, text_col, salts).join(clashing, "digest", "left_semi")
        joined = (
            members.join(clashing, "digest", "left_anti")
            .join(found.hint("merge"), "digest")
            .select("id", "digest", "keep_id", "group_size")
            .unionByName(by_content.join(exact.hint("merge"), ["digest", "content"]).select("id", "digest", "keep_id", "group_size"))
        )
    return joined.select(
        F.col("id").alias(id_col),
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op5_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(common.table(spark, sf_dir, "documents"))


SQL = {
    "op5_exact_dedup": """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS content
  FROM documents
)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY content) AS keep_id,
       count(*) OVER (PARTITION BY content) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY content) AS kept,
       sha256(content) AS text_sha256
FROM t
"""
}
