"""Array expressions whose cost does not grow with the square of an array's length."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(numbers: Column, start: Column, kind: str) -> Column:
    """start and the sum of the numbers before each; costs the square of a short array."""
    zero = F.struct(start.cast(kind).alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
    step = lambda d, x: F.struct((d["at"] + x).cast(kind).alias("at"), F.concat(d["out"], F.array(d["at"])).alias("out"))
    return F.aggregate(numbers, zero, step, lambda d: d["out"])


def _scan(numbers: Column, start: Column, kind: str, depth: int) -> Column:
    """What _running gives, block by block: an array of n is n ** (1 / depth) blocks."""
    if depth == 1:
        return _running(numbers, start, kind)

    def blocks(xs: Column) -> Column:
        size = F.ceil(F.pow(F.size(xs), F.lit((depth - 1) / depth))).cast("int")
        return F.transform(F.sequence(F.lit(0), F.size(xs) - 1, size), lambda i: F.slice(xs, i + 1, size))

    def run(parts: Column) -> Column:
        sums = F.transform(parts, lambda p: F.aggregate(p, F.lit(0).cast(kind), lambda a, x: (a + x).cast(kind)))
        return F.flatten(F.zip_with(parts, _running(sums, start, kind), lambda p, at: _scan(p, at, kind, depth - 1)))

    return bind(blocks(numbers), run)


def prefix_sums(numbers: Column, kind: str = "int") -> Column:
    """array<kind>: the sum of the numbers before each one.

    An array can only grow by being copied, so it is summed in blocks of blocks: n ** (4 / 3) instead of n * n.
    """
    return bind(numbers, lambda xs: F.when(F.size(xs) > 0, _scan(xs, F.lit(0), kind, 3)).otherwise(F.array().cast(f"array<{kind}>")))
