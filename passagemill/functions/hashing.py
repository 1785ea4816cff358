"""Identities: every id, fingerprint and split is a function of SHA-256 over unit-separated text."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT, ID_LENGTH, SPLIT_SEED = "\x1f", 32, "passagemill-v1"


def stable_json(value) -> str:
    """Compact JSON with sorted keys: what checksums are taken of."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def checksum(value) -> str:
    return hashlib.sha256(stable_json(value).encode()).hexdigest()


def make_id(*parts) -> str:
    """The driver-side twin of deterministic_id."""
    return hashlib.sha256(UNIT.join(map(str, parts)).encode()).hexdigest()[:ID_LENGTH]


def _joined(parts) -> Column:
    # concat_ws would skip nulls and so shift the parts
    return F.concat_ws(UNIT, *[F.coalesce((p if isinstance(p, Column) else F.lit(p)).cast("string"), F.lit("")) for p in parts])


def deterministic_id(*parts: Column | str | int) -> Column:
    """The first 32 hex digits of the SHA-256 of the unit-separated parts."""
    return F.substring(F.sha2(_joined(parts), 256), 1, ID_LENGTH)


def leading_number(col: Column) -> Column:
    """The number that the first eight hex digits are."""
    return F.conv(F.substring(col, 1, 8), 16, 10).cast("long")


def hash_fraction(identifier: Column) -> Column:
    return leading_number(identifier) / F.lit(4294967295.0)


def split_for_group(group: Column, seed: str = SPLIT_SEED) -> Column:
    """80 / 10 / 10 by hash, so that a group is in one split whatever else the corpus holds."""
    bucket = leading_number(F.sha2(_joined([seed, group]), 256)) % 100
    return F.when(bucket < 80, "train").when(bucket < 90, "validation").otherwise("test")


def split_for_index(index: Column) -> Column:
    return F.when(index % 10 == 0, "eval").otherwise("train")


def message_fingerprint(question: Column, answer: Column) -> Column:
    """The checksum of the two messages."""
    message = lambda role, text: F.struct(text.alias("content"), F.lit(role).alias("role"))
    return F.sha2(F.to_json(F.array(message("user", question), message("assistant", answer))), 256)
