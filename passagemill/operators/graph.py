"""Closure over the source graph's gold relations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import discard, materialize
from .records import row_numbers


def gold(relations: DataFrame) -> DataFrame:
    """Relations that may be followed: eligible, validated, and with a target."""
    return relations.where("gold_eligible and target_id is not null")


#: Rounds after which what was reached is written as one table again.
REWRITE = 8


def closure(relations: DataFrame, seeds: DataFrame, rounds: int = 1000) -> DataFrame:
    """(vertex, depth) of all that gold relations reach from the seeds (vertex). Cycles end where they meet what was reached.

    A frontier join: each round is written, so its lineage doesn't grow, and joins only the new vertices. What was reached is
    rewritten as one table every few rounds and its parts are deleted, so that a long chain doesn't become as many tables.
    """
    edges = materialize(gold(relations).select(F.col("source_id").alias("vertex"), F.col("target_id")).distinct(), "closure-edges")
    frontier = materialize(seeds.select("vertex").distinct().withColumn("depth", F.lit(0)), "closure")
    reached, parts = frontier, [frontier]
    for depth in range(1, rounds + 1):
        new = frontier.select("vertex").join(edges, "vertex").select(F.col("target_id").alias("vertex")).distinct()
        new = materialize(new.join(reached.select("vertex"), "vertex", "left_anti").withColumn("depth", F.lit(depth)), "closure")
        if new.isEmpty():
            discard(edges)
            return reached
        reached, frontier = reached.unionByName(new), new
        parts.append(new)
        if len(parts) > REWRITE:
            reached = materialize(reached, "closure")
            for done in parts[:-1]:
                discard(done)
            parts = [reached, new]
    raise RuntimeError(f"the closure did not end in {rounds} rounds")


#: Seeds whose closures travel together, as the bits of a long.
BITS = 64


@dataclass(frozen=True)
class Closures:
    """The closures of many seeds: seeds (seed, number), and which of a block's seeds reach a vertex: masks (vertex, block, mask)."""

    seeds: DataFrame
    masks: DataFrame

    def _numbered(self, rows: DataFrame) -> DataFrame:
        """rows with block and mask, as rows with the number of each seed that the mask has."""
        bits = F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.expr("mask").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), i)) != 0)
        return rows.withColumn("bit", F.explode(bits)).withColumn("number", F.col("block") * BITS + F.col("bit")).drop("block", "mask", "bit")

    def rows(self) -> DataFrame:
        """(seed, vertex) of all closures: as many rows as they have vertices together."""
        return self._numbered(self.masks).join(self.seeds.hint("merge"), "number").select("seed", "vertex")

    def missing(self, pairs: DataFrame) -> DataFrame:
        """The pairs (seed, vertex, any other columns) whose vertex the seed's closure doesn't hold; closures aren't spread out for that."""
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("number") % BITS).cast("int"))
        placed = pairs.join(self.seeds, "seed", "left").withColumn("block", F.floor(F.col("number") / BITS))
        met = placed.join(self.masks.hint("merge"), ["vertex", "block"], "left")
        return met.where(F.coalesce(F.col("mask").bitwiseAND(bit) == 0, F.lit(True))).select(*pairs.columns)

    def partition(self, relations: DataFrame) -> DataFrame:
        """(seed, pos, relation_id, allowed) of the relations that leave a seed's closure, with whether they may be followed."""
        leaving = relations.join(self.masks.withColumnRenamed("vertex", "source_id").hint("merge"), "source_id")
        allowed = F.coalesce(F.col("gold_eligible") & F.col("target_id").isNotNull(), F.lit(False)).alias("allowed")
        return self._numbered(leaving.select("pos", "relation_id", allowed, "block", "mask")).join(self.seeds.hint("merge"), "number").select("seed", "pos", "relation_id", "allowed")


def closures(relations: DataFrame, seeds: DataFrame, rounds: int = 1000) -> Closures:
    """The closures of all seeds (vertex) in one run, whose number of rounds is that of the longest way from any of them.

    A frontier row stands for up to 64 seeds that reach a vertex for the first time: (vertex, block, mask). A round joins the frontier with the
    relations, merges the masks of each target before and after the shuffle, and leaves out the bits that the target has already.
    """
    numbered = row_numbers(seeds.select(F.col("vertex").alias("seed")).where("seed is not null").distinct(), F.col("seed"))
    numbered = materialize(numbered.select("seed", F.col("ordinal").alias("number")), "seeds")
    edges = materialize(gold(relations).select(F.col("source_id").alias("vertex"), F.col("target_id")).distinct(), "closure-edges")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("number") % BITS).cast("int"))
    frontier = materialize(numbered.select(F.col("seed").alias("vertex"), F.floor(F.col("number") / BITS).alias("block"), bit.alias("mask")), "closures")
    merged = lambda df: df.groupBy("vertex", "block").agg(F.bit_or("mask").alias("mask"))
    reached, parts = frontier, [frontier]
    for _ in range(rounds):
        step = merged(frontier.join(edges.hint("merge"), "vertex").select(F.col("target_id").alias("vertex"), "block", "mask"))
        known = merged(reached).withColumnRenamed("mask", "known")
        new = step.join(known.hint("merge"), ["vertex", "block"], "left").select("vertex", "block", F.col("mask").bitwiseAND(F.bitwise_not(F.coalesce("known", F.lit(0).cast("long")))).alias("mask"))
        new = materialize(new.where("mask <> 0"), "closures")
        if new.isEmpty():
            whole = materialize(merged(reached), "closures")
            for done in (edges, new, *parts):
                discard(done)
            return Closures(numbered, whole)
        reached, frontier = reached.unionByName(new), new
        parts.append(new)
        if len(parts) > REWRITE:
            reached = materialize(merged(reached), "closures")
            for done in parts[:-1]:
                discard(done)
            parts = [reached, new]
    raise RuntimeError(f"the closures did not end in {rounds} rounds")


def partition(relations: DataFrame, reached: DataFrame) -> DataFrame:
    """The relations that leave reached vertices, with allowed: whether they may be followed; order is the graph's own (pos)."""
    outgoing = relations.join(reached.select(F.col("vertex").alias("source_id")), "source_id", "left_semi")
    return outgoing.withColumn("allowed", F.coalesce(F.col("gold_eligible") & F.col("target_id").isNotNull(), F.lit(False)))


def unreachable(targets: DataFrame, reached: DataFrame) -> DataFrame:
    """The targets (vertex) that the closure does not hold; must be empty before anything is generated."""
    return targets.join(reached.select("vertex"), "vertex", "left_anti")


def null_safe_support(spans: DataFrame, addresses: DataFrame, **more: str) -> DataFrame:
    """Spans with their strong addresses; a missing offset equals a missing offset only. more: columns of the addresses by the names that they get."""
    s, a = spans.alias("s"), addresses.alias("a")
    same = (F.col("s.node_id") == F.col("a.node_id")) & F.col("s.char_start").eqNullSafe(F.col("a.char_start")) & F.col("s.char_end").eqNullSafe(F.col("a.char_end"))
    return s.join(a, same).select("s.*", "a.address_id", *[F.col(f"a.{column}").alias(name) for name, column in more.items()])
