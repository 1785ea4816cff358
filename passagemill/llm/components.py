"""Connected components of a link table, by alternating large and small stars.

Both steps replace a node's links by links to its smallest neighbour; the number of rounds grows with the
logarithm of a component's size, not with its diameter. A hub with very many links is dealt over tasks; nothing is
collected or broadcast but two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Parts that a hub's links are dealt into.
DEALS = 256


def _with_least(links: DataFrame) -> DataFrame:
    """links (u, v) with m, the least v of u.

    A hub's links are dealt by a hash of v: the least is first found for each deal, then over the deals, and goes back to just the
    deals that occur. So no task gets more of a hub than a deal, in the aggregate or in the join.
    """
    dealt = links.withColumn("deal", F.pmod(F.xxhash64("v"), F.lit(DEALS))).repartition("u", "deal")  # one shuffle for the aggregate and the join
    by_deal = dealt.groupBy("u", "deal").agg(F.min("v").alias("m"))
    least = by_deal.groupBy("u").agg(F.min("m").alias("m"), F.collect_list("deal").alias("deals"))
    return dealt.join(least.select("u", "m", F.explode("deals").alias("deal")).hint("merge"), ["u", "deal"]).select("u", "v", "m")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    least = _with_least(links)
    moved = least.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(u, root) of every node that has a link; root is the component's smallest node. links: (u, v), any direction."""
    links = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links = common.materialize(links, "links")
    before = None
    for _ in range(rounds):
        done, links = links, common.materialize(_small_star(_large_star(links)).distinct(), "links")
        common.discard(done)
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return links.select("u", F.col("v").alias("root")).unionByName(links.select(F.col("v").alias("u"), F.col("v").alias("root")).distinct())
        before = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
