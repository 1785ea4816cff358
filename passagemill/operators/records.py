"""Records: groups, splits, first-wins dedup, roles and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import SPLIT_SEED, split_for_group
from ..sources.scratch import materialize


def record_group(assets: Column, documents: Column, unit: Column, evidence: Column) -> Column:
    """What must not be torn apart by the split: the least asset, else document, else unit, else evidence."""
    least = lambda name, a: F.when(F.size(a) > 0, F.concat(F.lit(name + ":"), F.array_min(a)))
    return F.coalesce(
        least("source_asset_ids", assets),
        least("document_ids", documents),
        F.when(unit != "", F.concat(F.lit("knowledge_unit:"), unit)),
        least("evidence", evidence),
        F.lit("ungrouped"),
    )


def _ordered(kind) -> bool:
    """Whether values of a type have an order."""
    told = kind.simpleString()
    return "map<" not in told and "variant" not in told


def first_wins(df: DataFrame, fingerprint: str, order: list[str]) -> DataFrame:
    """The first row, in the given order, of each fingerprint.

    An aggregate rather than a window: it combines before the shuffle, so one fingerprint of very many rows is no hot task.
    """
    rest = [c for c in df.columns if c != fingerprint and c not in order]
    first = F.min_by(F.struct(*rest), F.struct(*order)) if rest else F.lit(None)
    if all(_ordered(df.schema[c].dataType) for c in rest):
        # one struct, in the given order first: rows that carry nothing twice
        found = df.groupBy(fingerprint).agg(F.min(F.struct(*dict.fromkeys([c for c in order if c != fingerprint]), *rest)).alias("_first"))
        return found.select(fingerprint, "_first.*").select(*df.columns)
    found = df.groupBy(fingerprint).agg(first.alias("_first"), F.min(F.struct(*order)).alias("_order"))
    return found.select(fingerprint, "_first.*", *[F.col("_order")[c].alias(c) for c in order if c != fingerprint]).select(*df.columns)


def with_split(df: DataFrame, group: Column, seed: str = SPLIT_SEED) -> DataFrame:
    return df.withColumn("split_group_id", group).withColumn("split", split_for_group(F.col("split_group_id"), seed))


def research_role(df: DataFrame) -> DataFrame:
    """Train rows may be trained on; all others are evaluation rows of the split they had."""
    train = F.col("split") == "train"
    return df.select(
        "*",
        F.when(train, "training").otherwise(F.concat(F.lit("legacy_"), "split")).alias("research_role"),
        train.alias("training_eligible"),
        F.when(~train, F.col("split")).alias("original_split"),
    )


def split_metrics() -> dict[str, Column]:
    """A manifest's counts, as aggregates of whatever pass there is over the records."""
    counts = {f"{s}_count": F.count_if(F.col("split") == s) for s in ("train", "validation", "test")}
    return counts | {"eval_count": F.count_if(F.col("split") != "train")}


def split_counts(df: DataFrame) -> DataFrame:
    """One pass for a manifest's counts."""
    return df.agg(*[c.alias(name) for name, c in split_metrics().items()])


def keep_ordered(df: DataFrame, key: list[str], order: str, value: str, alias: str) -> DataFrame:
    """value of each key as an array in the given order, which a plain collect_list doesn't promise."""
    pairs = F.array_sort(F.collect_list(F.struct(order, value)))
    return df.groupBy(*key).agg(F.transform(pairs, lambda x: x[value]).alias(alias))


def row_numbers(df: DataFrame, *order: Column) -> DataFrame:
    """Ordinals of a whole table, from 0: a range sort, then numbers within partitions on top of the partitions' sizes.

    A window without a key would put the table into one task. The sorted partitions are written once with their numbers: a range
    sort samples anew each time it runs, so sizes of another run would be those of another split. Only the sizes are collected.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    written = materialize(dealt.withColumns({"_part": F.shiftright("_id", 33).cast("int"), "_in": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))}), "numbered")
    base, starts = 0, []
    for part, n in written.groupBy("_part").count().orderBy("_part").collect():
        starts.append((part, base))
        base += n
    offsets = df.sparkSession.createDataFrame(starts, "_part int, _base long")
    # one row a partition
    return written.join(F.broadcast(offsets), "_part").withColumn("ordinal", F.col("_base") + F.col("_in")).drop("_id", "_part", "_in", "_base")


def in_shards(rows: DataFrame, kept: DataFrame, order: list[str], shard_rows: int) -> DataFrame:
    """The rows of which kept has the order's columns, with ordinal, their place in that order, and shard; a shard is in one task.

    The order's last column is hexadecimal; all of them tell rows apart. Only kept's few columns are sorted and numbered; the rows, which are long, learn their
    shard from the keys that shards begin with (a row a shard), and are shuffled once, to where the ordinals of their shard are.
    """
    *first, last = order
    binary = lambda df: df.withColumn(last, F.unhex(last))  # noqa: E731  half of the digits, in the same order
    numbered = row_numbers(binary(kept.select(*order)), *map(F.col, order))
    starts = numbered.where(F.col("ordinal") % shard_rows == 0).orderBy("ordinal").select(*order).collect()
    kinds = {c: numbered.schema[c].dataType for c in order}
    begin = F.array(*[F.struct(*[F.lit(r[c]).cast(kinds[c]).alias(c) for c in order]) for r in starts])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range((len(starts) - 1).bit_length()))]) if len(starts) > 1 else F.array().cast("array<int>")
    # the last shard that begins at the key or before it, by halves; as a variable, the key is made once
    place = lambda key: F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(begin, at + step) <= key, at + step).otherwise(at))
    shard = F.get(F.transform(F.array(F.struct(*order)), place), F.lit(0)).cast("long")
    long = binary(rows).withColumns({"shard": shard, "ordinal": F.lit(None).cast("long")})
    told = numbered.select(*order, "ordinal", F.floor(F.col("ordinal") / shard_rows).cast("long").alias("shard"))
    # a union in one shuffle: a join of the two would shuffle the rows by the key and then again by the shard
    met = long.withColumn("_row", F.lit(True)).unionByName(told, allowMissingColumns=True).repartition("shard")
    found = met.withColumn("ordinal", F.max("ordinal").over(Window.partitionBy("shard", last, *first)))
    return found.where("_row and ordinal is not null").drop("_row").withColumn(last, F.lower(F.hex(last)))
