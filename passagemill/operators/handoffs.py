"""Handoffs of many segments and many evidence sets at once.

`handoff` makes one record with a handful of jobs; here all records of a kind are made together, in a number of jobs that doesn't depend on
how many there are: supports and addresses are joins, the closures of all seeds are one run (`graph.closures`), and the generators
are asked where the rows are. What must not be handed on is a row of `refused`, with its problem, and is never asked about;
`Handed.require` makes an error of it, as the functions for one record do.

A record is one row, as it is one document in the end, so a set's claims and a segment's texts come together in one place; sets, segments
and seeds don't.

Defined cases: a set or segment that is given twice is refused, as its record wouldn't be one; a null array is an empty one, and a set or a
segment without members is refused; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import deterministic_id
from ..prompts import template
from ..sources.scratch import materialize
from . import graph as G
from . import responder as M
from .clients import Role
from .handoff import COMPOSITE_SCHEMA, PARAGRAPH_SCHEMA, TEXT_LIMIT, Bundle, HandoffError, SupportError, copy_columns

FLAGS = ("copies_source", "trainable_source", "rewrites_source")
#: Problems that a support has; the others are those of the record itself.
OF_SUPPORT = ("no_exact_address", "forbidden", "obsolete", "unresolved", "not_reached")


@dataclass(frozen=True)
class Handed:
    """records; refused (the record's id columns, problem, id); calls: what was told of each question.

    Of composites also the records without their relations, and the relations of each seed: a record has all of its seed's, so records of many
    sets are many copies of them, which whoever wants less than the copies need not make.
    """

    records: DataFrame
    refused: DataFrame
    calls: DataFrame
    bare: DataFrame | None = None
    by_seed: DataFrame | None = None

    def require(self) -> DataFrame:
        first = self.refused.limit(1).collect()
        if first:
            raise (SupportError if first[0].problem in OF_SUPPORT else HandoffError)(f"{first[0].problem}: {first[0].id}")
        return self.records


def claim_text(raw: str) -> str:
    """A claim's text, which must be there and bounded."""
    text = raw.strip()
    if not 0 < len(text) <= TEXT_LIMIT:
        raise ValueError("a claim must be a bounded text")
    return text


def _bounded_answer(raw: str) -> dict[str, str]:
    told = M.question_answer(raw)
    if not all(0 < len(x) <= TEXT_LIMIT for x in told.values()):
        raise ValueError("question and answer must be bounded texts")
    return told


def _ask(rows: DataFrame, key: list[str], role: Role, parse: Callable[[str], Any], schema: str, factory: Callable[[], Any], name: str, also: tuple[str, ...] = ()) -> DataFrame:
    """(key columns, columns that go along, value, call) of the rows' texts, written before anything reads it."""
    asked = rows.select(deterministic_id(*map(F.col, key)).alias("asked"), *key, *also, "text")
    told = M.ask(asked, role, "text", template(role.name), parse, schema, factory, key="asked", also=(*key, *also))
    return materialize(told.select(*key, *also, "value", "call"), name)


def _problem(rows: DataFrame, ids: list[str], problem, about) -> DataFrame:
    return rows.select(*ids, problem.alias("problem"), about.cast("string").alias("id"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def _safe(records: DataFrame) -> DataFrame:
    found = copy_columns(records.schema)
    if found:
        raise HandoffError(f"a field would carry copied source text: {found[0]}")
    return records


def _support_problem(status) -> Any:
    return F.when(status.isNull(), "no_exact_address").when(status != "exact", status)


def paragraphs(bundle: Bundle, spans: DataFrame, role: Role = Role("generator"), factory: Callable[[], Any] = M.DeterministicResponder) -> Handed:
    """A question and an answer for each segment. spans: (view_id, segment_id, pos, node_id, char_start, char_end) of all segments."""
    bundle.validate()
    ids = ["view_id", "segment_id"]
    spans = materialize(spans.select(*ids, "pos", "node_id", "char_start", "char_end"), "spans")
    found = materialize(G.null_safe_support(spans, bundle.addresses, place="pos", status="status").select(*ids, "pos", "address_id", "place", "status"), "supports")
    bare = spans.join(found.select(*ids, "pos"), [*ids, "pos"], "left_anti")
    repeated = spans.groupBy(*ids, "pos").count().where("count > 1")
    refused = [
        _problem(bare, ids, F.lit("no_exact_address"), F.col("node_id")),
        _problem(found.where("status <> 'exact'"), ids, F.col("status"), F.col("address_id")),
        _problem(repeated, ids, F.lit("segment_repeated"), F.col("segment_id")),
    ]
    refused = materialize(_union(refused).distinct(), "refused-segments")
    good = found.join(refused.select(*ids).distinct(), ids, "left_anti")
    texts = bundle.address_texts(good.select("address_id").distinct()).select("address_id", "text")
    # an address that several spans have stands where it comes first
    firsts = good.groupBy(*ids, "address_id").agg(F.min(F.struct("pos", "place")).alias("at")).join(texts, "address_id")
    ordered = F.array_sort(F.collect_list(F.struct("at", "address_id", "text")))
    whole = firsts.groupBy(*ids).agg(ordered.alias("parts")).select(*ids, F.transform("parts", lambda x: x["address_id"]).alias("support_ids"), F.array_join(F.transform("parts", lambda x: x["text"]), "\n").alias("text"))
    told = _ask(whole, ids, role, _bounded_answer, "struct<instruction:string,answer:string>", factory, "segment-answers", also=("support_ids",))
    failed = _problem(told.where("value is null"), ids, F.lit("generation_failed"), F.col("segment_id"))
    records = told.where("value is not null").select(
        *ids, F.col("value.instruction").alias("question"), F.col("value.answer").alias("answer"), "support_ids", F.lit(PARAGRAPH_SCHEMA).alias("schema"), *[F.lit(False).alias(x) for x in FLAGS]
    )
    return Handed(_safe(records), refused.unionByName(failed), told.select(*ids, "call"))


def edges(bundle: Bundle) -> DataFrame:
    """The source graph's relations, and those from divisions to their nodes."""
    contains = bundle.divisions.select(F.col("division_id").alias("source_id"), F.col("node_id").alias("target_id"), F.lit(True).alias("gold_eligible"))
    return bundle.relations.select("source_id", "target_id", "gold_eligible").unionByName(contains)


def composites(bundle: Bundle, sets: DataFrame, role: Role = Role("claim"), factory: Callable[[], Any] = M.DeterministicResponder) -> Handed:
    """A claim for each member of each evidence set. sets: (evidence_set_id, seed_id, claim_ids, member_ids)."""
    bundle.validate()
    ids, none = ["evidence_set_id"], F.array().cast("array<string>")
    sets = materialize(sets.select("evidence_set_id", "seed_id", *[F.coalesce(c, none).alias(c) for c in ("claim_ids", "member_ids")]), "sets")
    target = bundle.addresses.select(F.col("address_id").alias("member_id"), "status", F.coalesce("node_id", "division_id").alias("vertex"))
    claims = sets.select("evidence_set_id", F.col("seed_id").alias("seed"), F.posexplode(F.arrays_zip("claim_ids", "member_ids")).alias("pos", "x"))
    claims = claims.select("evidence_set_id", "seed", "pos", F.col("x.claim_ids").alias("claim_id"), F.col("x.member_ids").alias("member_id"))
    claims = materialize(claims.join(target.hint("merge"), "member_id", "left"), "claims")
    closures = G.closures(edges(bundle), sets.select(F.col("seed_id").alias("vertex")))
    given = F.col("claim_ids")
    odd = (F.size(given) == 0) | (F.size(F.array_distinct(given)) < F.size(given)) | F.exists(given, lambda x: F.coalesce(x == "", F.lit(True)))
    of_sets = F.when(F.size(given) != F.size("member_ids"), "claims_and_members_differ").when(odd, "claims_not_distinct")
    supported = F.col("status") == "exact"
    # each seed's targets once, however many claims have them
    lost = closures.missing(claims.where(supported).select("seed", "vertex").distinct()).select(F.col("seed").alias("of"), F.col("vertex").alias("at"))
    unreached = claims.where(supported).join(lost, F.col("seed").eqNullSafe(F.col("of")) & F.col("vertex").eqNullSafe(F.col("at")), "left_semi")
    refused = [
        _problem(sets.withColumn("problem", of_sets).where("problem is not null"), ids, F.col("problem"), F.col("evidence_set_id")),
        _problem(sets.groupBy(*ids).count().where("count > 1"), ids, F.lit("set_repeated"), F.col("evidence_set_id")),
        _problem(claims.withColumn("problem", _support_problem(F.col("status"))).where("problem is not null"), ids, F.col("problem"), F.col("member_id")),
        _problem(unreached, ids, F.lit("not_reached"), F.col("vertex")),
    ]
    refused = materialize(_union(refused).distinct(), "refused-sets")
    good = claims.join(refused.select(*ids).distinct(), ids, "left_anti")
    texts = bundle.address_texts(good.select(F.col("member_id").alias("address_id")).distinct()).select(F.col("address_id").alias("member_id"), "text")
    told = _ask(good.join(texts, "member_id").select(*ids, "seed", "pos", "claim_id", "member_id", "text"), [*ids, "pos", "claim_id", "member_id"], role, claim_text, "string", factory, "claim-answers", also=("seed",))
    failed = _problem(told.where("value is null"), ids, F.lit("claim_failed"), F.col("claim_id"))
    made = F.struct("pos", "claim_id", F.col("value").alias("text"), F.col("member_id").alias("support_id"))
    by_set = told.groupBy(*ids, F.col("seed").alias("seed_id")).agg(F.array_sort(F.collect_list(made)).alias("claims"), F.count_if(F.col("value").isNull()).alias("n_failed")).where("n_failed = 0")
    split = closures.partition(bundle.relations)
    chosen = lambda ok: F.transform(F.array_sort(F.collect_list(F.when(F.col("allowed") == ok, F.struct("pos", "relation_id")))), lambda x: x["relation_id"])
    by_seed = split.groupBy(F.col("seed").alias("seed_id")).agg(chosen(True).alias("allowed_relations"), chosen(False).alias("excluded_relations"))
    bare = by_set.select("seed_id", "evidence_set_id", F.transform("claims", lambda x: F.struct(x["claim_id"].alias("claim_id"), x["text"].alias("text"), x["support_id"].alias("support_id"))).alias("claims"))
    records = bare.join(by_seed.hint("merge"), "seed_id", "left").select(
        *bare.columns, F.coalesce("allowed_relations", none).alias("allowed_relations"), F.coalesce("excluded_relations", none).alias("excluded_relations"),
        F.lit(COMPOSITE_SCHEMA).alias("schema"), F.struct(*[F.lit(False).alias(x) for x in FLAGS]).alias("safety"),
    )
    return Handed(_safe(records), refused.unionByName(failed), told.select(*ids, "claim_id", "call"), bare, by_seed)
