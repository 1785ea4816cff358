"""What the operators of this package share: tables, scratch tables in the shared folder, Arrow batch bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import discard, materialize, scratch_path

__all__ = ["ascii_lower", "bound_batches", "discard", "materialize", "scratch_path", "skew_join", "table"]

#: Bytes of an Arrow batch sent to a Python worker; bounds its memory whatever the texts' lengths.
ARROW_BATCH_BYTES = 8 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches by bytes, as a batch of long texts would else not fit in a Python worker."""
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH_BYTES),):
        now = spark.conf.get(key, None)
        if not now or not now.isdigit() or int(now) > most:
            spark.conf.set(key, str(most))


def ascii_lower(col: Column | str) -> Column:
    """A-Z only, unlike lower()."""
    return F.translate(col, UPPER, LOWER)


def skew_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", salts: int = 64) -> DataFrame:
    """left join right on keys of which some can have very many rows in `left`; right's rows of a key should be few.

    A key's rows are dealt by a hash of all their columns, and right's go to just the deals that occur, so that a hot key is
    up to `salts` tasks' work however its rows are spread.
    """
    dealt = left.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salts)))
    met = dealt.select(*keys, "_salt").distinct().join(right.hint("merge"), keys)
    return dealt.join(met.hint("merge"), [*keys, "_salt"], how).drop("_salt")
