"""Provenance handoff: questions and claims that rest on exact addresses of canonical content.

All proofs are run to their end before anything is generated: each is a table of violations that must be empty, and an action
on it comes first. Records have a closed shape, so no copied source text can travel in them.
"""

from __future__ import annotations

import re
from dataclasses import asdict, dataclass, field
from typing import Any, Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from ..functions.fields import keys_within
from ..functions.hashing import make_id
from ..prompts import template
from ..sources.scratch import materialize
from ..sources.store import ArtifactStore, canonical_json
from . import clients
from . import graph as G
from .responder import question_answer

PARAGRAPH_SCHEMA, COMPOSITE_SCHEMA = "paragraph-qa-handoff/v1", "composite-ku-handoff/v1"
TEXT_LIMIT = 1_000_000
#: Field names that would carry copied source text.
COPIES = frozenset(("source_text", "paragraph_text", "evidence_text", "excerpt", "quoted_source", "context_text", "canonical_text_copy"))
IDENTITY = re.compile(r"[A-Za-z0-9][A-Za-z0-9._:-]{0,255}")


class HandoffError(ValueError):
    """A record, bundle or support that must not be handed on."""


class SupportError(HandoffError):
    """A support that is not exact, or not reachable."""


class QuestionAnswerGenerator(Protocol):
    def generate(self, text: str) -> tuple[str, str]: ...


class ClaimGenerator(Protocol):
    def claim(self, text: str) -> str: ...


@dataclass(frozen=True)
class ModelQuestions:
    """A question and answer generator that asks a model."""

    pool: clients.Pool
    role: clients.Role

    def generate(self, text: str) -> tuple[str, str]:
        told = question_answer(clients.call(self.pool, self.role, _messages(self.role, text), [])[0])
        return told["instruction"], told["answer"]


@dataclass(frozen=True)
class ModelClaims:
    """A claim generator that asks a model."""

    pool: clients.Pool
    role: clients.Role

    def claim(self, text: str) -> str:
        return clients.call(self.pool, self.role, _messages(self.role, text), [])[0].strip()


def _messages(role: clients.Role, text: str) -> list[dict[str, str]]:
    return [{"role": "system", "content": template(role.name)}, {"role": "user", "content": text}]


def refuse_copies(value: Any) -> None:
    """Refuses a value in which a field that would carry copied source text is anywhere; what fields hold isn't looked at."""
    found = sorted(COPIES.intersection(keys_within(value)))
    if found:
        raise HandoffError(f"a field would carry copied source text: {found[0]}")


def copy_columns(schema: DataType, path: str = "") -> list[str]:
    """The fields of a schema, within structs, arrays and maps, that would carry copied source text."""
    if isinstance(schema, StructType):
        return [x for f in schema.fields for x in ([f"{path}{f.name}"] if f.name in COPIES else []) + copy_columns(f.dataType, f"{path}{f.name}.")]
    if isinstance(schema, ArrayType):
        return copy_columns(schema.elementType, path)
    return [*copy_columns(schema.keyType, path), *copy_columns(schema.valueType, path)] if isinstance(schema, MapType) else []


def copies_within(rows: DataFrame, key: str, value: str, depth: int = 100) -> DataFrame:
    """(key, field) of the forbidden fields anywhere in rows of any shape (value: VARIANT). One pass a level of nesting, until none is left."""
    spark, found = rows.sparkSession, None
    level = rows.select(F.col(key).alias("row_key"), F.col(value).alias("row_value"))
    for _ in range(depth):
        level = materialize(spark.sql("SELECT row_key, x.key AS field, to_json(x.value) AS inner FROM {level}, LATERAL variant_explode(row_value) AS x", level=level), "fields")
        told = level.where(F.col("field").isin(*sorted(COPIES))).select("row_key", "field")
        found = told if found is None else found.unionByName(told)
        level = level.where("inner LIKE '{%' OR inner LIKE '[%'").select("row_key", F.parse_json("inner").alias("row_value"))
        if level.isEmpty():
            return found.distinct().withColumnRenamed("row_key", key)
    raise HandoffError(f"a value is nested more than {depth} levels deep")


def _distinct(name: str, values: tuple[str, ...]) -> None:
    if isinstance(values, str) or not values or any(not isinstance(v, str) or not v for v in values) or len(set(values)) < len(values):
        raise HandoffError(f"{name} must be distinct ids")


@dataclass(frozen=True)
class Bundle:
    """One document's canonical content, source graph and addresses, as tables.

    nodes (node_id, resource_id, owner_division_id, text), divisions (division_id, pos, node_id),
    resources (resource_id, source_sha256), graph_resources (the same), relations (pos, source_id, target_id, gold_eligible),
    addresses (pos, address_id, graph_revision, resource_id, node_id, division_id, char_start, char_end, status).
    """

    graph_revision: str
    nodes: DataFrame
    divisions: DataFrame
    resources: DataFrame
    graph_resources: DataFrame
    relations: DataFrame
    addresses: DataFrame

    def violations(self) -> DataFrame:
        """(problem, id) of all that doesn't fit together."""
        r, g, a, n = self.resources, self.graph_resources, self.addresses, self.nodes
        told = lambda df, problem, column: df.select(F.lit(problem).alias("problem"), F.col(column).cast("string").alias("id"))
        either = r.exceptAll(g).unionByName(g.exceptAll(r))
        owned = a.where("node_id is not null").join(n.select("node_id", F.col("resource_id").alias("owner"), F.length("text").alias("n")), "node_id", "left")
        parts = [
            told(either, "resource_differs", "resource_id"),
            told(r.groupBy("resource_id").count().where("count > 1"), "resource_repeated", "resource_id"),
            told(a.where(F.col("graph_revision") != self.graph_revision), "other_revision", "address_id"),
            told(a.groupBy("address_id").count().where("count > 1"), "address_repeated", "address_id"),
            told(owned.where("owner is null"), "target_missing", "address_id"),
            told(owned.where("owner <> resource_id"), "resource_does_not_own_target", "address_id"),
            told(owned.where("char_end > n or char_start < 0 or char_start >= char_end"), "out_of_bounds", "address_id"),
            told(a.where("division_id is not null").join(self.divisions.select("division_id").distinct(), "division_id", "left_anti"), "target_missing", "address_id"),
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def validate(self) -> Bundle:
        first = self.violations().limit(1).collect()
        if first:
            raise HandoffError(f"{first[0].problem}: {first[0].id}")
        return self

    def division_texts(self) -> DataFrame:
        """(division_id, text): the direct nodes' texts, by line."""
        each = self.divisions.join(self.nodes.select("node_id", "text"), "node_id")
        lines = F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"])
        return each.groupBy("division_id").agg(F.array_join(lines, "\n").alias("text"))

    def address_texts(self, ids: DataFrame) -> DataFrame:
        """(address_id, vertex, text) of the addresses' targets: a node, a part of it, or a division."""
        a = self.addresses.join(ids, "address_id")
        node = a.where("node_id is not null").join(self.nodes.select("node_id", "text"), "node_id")
        part = F.when(F.col("char_start").isNull(), F.col("text")).otherwise(F.substring("text", F.col("char_start") + 1, F.col("char_end") - F.col("char_start")))
        whole = a.where("division_id is not null").join(self.division_texts(), "division_id")
        return node.select("address_id", F.col("node_id").alias("vertex"), part.alias("text")).unionByName(whole.select("address_id", F.col("division_id").alias("vertex"), "text"))


def require_exact(supports: DataFrame, wanted: DataFrame, key: str) -> None:
    """Every wanted key has an address, and every address resolves exactly."""
    missing = wanted.join(supports.select(key), key, "left_anti").limit(1).collect()
    if missing:
        raise SupportError(f"no exact address: {missing[0][0]}")
    bad = supports.where("status <> 'exact'").limit(1).collect()
    if bad:
        raise SupportError(f"{bad[0].status}: {bad[0].address_id}")


@dataclass(frozen=True)
class ParagraphHandoff:
    view_id: str
    segment_id: str
    question: str
    answer: str
    support_ids: tuple[str, ...]
    schema: str = PARAGRAPH_SCHEMA
    copies_source: bool = False
    trainable_source: bool = False
    rewrites_source: bool = False

    def validate(self) -> ParagraphHandoff:
        _distinct("support_ids", self.support_ids)
        if self.schema != PARAGRAPH_SCHEMA or any(x is not False for x in (self.copies_source, self.trainable_source, self.rewrites_source)):
            raise HandoffError("the record's tag or safety flags are wrong")
        if not all(isinstance(x, str) and 0 < len(x) <= TEXT_LIMIT for x in (self.question, self.answer)):
            raise HandoffError("question and answer must be bounded texts")
        refuse_copies(asdict(self))
        return self


@dataclass(frozen=True)
class Claim:
    claim_id: str
    text: str
    support_id: str


@dataclass(frozen=True)
class CompositeHandoff:
    seed_id: str
    evidence_set_id: str
    claims: tuple[Claim, ...]
    allowed_relations: tuple[str, ...]
    excluded_relations: tuple[str, ...]
    schema: str = COMPOSITE_SCHEMA
    safety: dict[str, bool] = field(default_factory=lambda: {"copies_source": False, "trainable_source": False, "rewrites_source": False})

    def validate(self) -> CompositeHandoff:
        _distinct("claims", tuple(c.claim_id for c in self.claims))
        if self.schema != COMPOSITE_SCHEMA or set(self.safety.values()) != {False}:
            raise HandoffError("the record's tag or safety flags are wrong")
        if set(self.allowed_relations) & set(self.excluded_relations):
            raise HandoffError("a relation is both allowed and excluded")
        if not all(0 < len(c.text) <= TEXT_LIMIT for c in self.claims):
            raise HandoffError("claims must be bounded texts")
        refuse_copies(asdict(self))
        return self


def build_paragraph(bundle: Bundle, view_id: str, segment_id: str, spans: DataFrame, generator: QuestionAnswerGenerator) -> ParagraphHandoff:
    """spans: (pos, node_id, char_start, char_end) of the segment; every one needs an exact address of its own."""
    bundle.validate()
    supports = G.null_safe_support(spans, bundle.addresses).join(bundle.addresses.select("address_id", F.col("pos").alias("place"), "status"), "address_id")
    require_exact(supports, spans, "pos")
    found = [r.address_id for r in supports.orderBy("pos", "place").select("address_id").collect()]
    texts = bundle.address_texts(supports.groupBy("address_id").agg(F.min("pos").alias("first"))).select("address_id", "text")
    by_id = {r.address_id: r.text for r in texts.collect()}
    ids = tuple(dict.fromkeys(found))
    question, answer = generator.generate("\n".join(by_id[i] for i in ids))
    return ParagraphHandoff(view_id, segment_id, question, answer, ids).validate()


def build_composite(bundle: Bundle, seed_id: str, evidence_set_id: str, claim_ids: list[str], member_ids: list[str], generator: ClaimGenerator) -> CompositeHandoff:
    """A claim for each member of the evidence set; every member resolves exactly and is reached from the seed."""
    if len(claim_ids) != len(member_ids):
        raise HandoffError("claims and members differ in number")
    bundle.validate()
    spark = bundle.nodes.sparkSession
    members = spark.createDataFrame([(m,) for m in dict.fromkeys(member_ids)], "address_id string")
    require_exact(members.join(bundle.addresses, "address_id"), members, "address_id")
    contains = bundle.divisions.select(F.col("division_id").alias("source_id"), F.col("node_id").alias("target_id"), F.lit(True).alias("gold_eligible"))
    edges = bundle.relations.select("source_id", "target_id", "gold_eligible").unionByName(contains)
    reached = G.closure(edges, spark.createDataFrame([(seed_id,)], "vertex string"))
    texts = bundle.address_texts(members)
    lost = G.unreachable(texts.select("vertex"), reached).limit(1).collect()
    if lost:
        raise SupportError(f"not reached from {seed_id}: {lost[0].vertex}")
    split = [(r.relation_id, r.allowed) for r in G.partition(bundle.relations, reached).orderBy("pos").select("relation_id", "allowed").collect()]
    by_id = {r.address_id: r.text for r in texts.collect()}
    claims = tuple(Claim(c, generator.claim(by_id[m]), m) for c, m in zip(claim_ids, member_ids))
    return CompositeHandoff(seed_id, evidence_set_id, claims, tuple(r for r, ok in split if ok), tuple(r for r, ok in split if not ok)).validate()


def put(store: ArtifactStore, identity: str, handoff: ParagraphHandoff | CompositeHandoff) -> str:
    """Write a record once under its identity; other bytes under it are a conflict."""
    if not isinstance(handoff, (ParagraphHandoff, CompositeHandoff)):
        raise HandoffError("not a handoff record")
    if not IDENTITY.fullmatch(identity):
        raise HandoffError(f"not an identity: {identity!r}")
    value = asdict(handoff.validate())
    refuse_copies(value)
    kind = "paragraph-qa" if isinstance(handoff, ParagraphHandoff) else "composite-ku"
    return store.put(f"handoffs/{kind}/{make_id(identity)}.json", canonical_json(value))
