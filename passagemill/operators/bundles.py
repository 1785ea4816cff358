"""Bundles from stored artifacts: canonical content, one source graph, one address catalog; resolvers and segmentations bound to them.

Canonical artifacts are read, hashed and parsed where Spark puts their files; graph and catalog are one artifact each. Whatever
is bound to a bundle must be so by its bytes: matching ids are not enough.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.manifest import Source
from ..sources.scratch import materialize
from ..sources.store import ArtifactStore, canonical_json, canonical_record
from .handoff import Bundle, HandoffError, SupportError

NODE = "struct<node_id:string,resource_id:string,owner_division_id:string,text:string>"
RESOURCE = "struct<resource_id:string,source_sha256:string>"
ARTIFACT = f"digest string, nodes array<{NODE}>, resources array<{RESOURCE}>, error string"
SPAN = "artifact string, view_id string, segment_id string, kind string, pos int, node_id string, char_start int, char_end int"
RELATION = "pos int, relation_id string, source_id string, target_id string, gold_eligible boolean"
ADDRESS = "pos int, address_id string, graph_revision string, resource_id string, node_id string, division_id string, char_start int, char_end int"
#: States of a relation in which it can be gold.
VALIDATED = ("validated", "human-validated")


def digest(value: Any) -> str:
    return hashlib.sha256(canonical_json(value)).hexdigest()


@dataclass(frozen=True)
class Resolver:
    """Which addresses resolve how; made for one graph and one catalog, by their bytes."""

    graph_digest: str
    catalog_digest: str
    forbidden: frozenset[str] = frozenset()
    obsolete: frozenset[str] = frozenset()


@dataclass(frozen=True)
class Intent:
    """A set of evidence that isn't in the catalog: a claim for each member."""

    address_id: str
    claim_ids: tuple[str, ...]
    member_ids: tuple[str, ...]


@dataclass(frozen=True)
class Loaded:
    bundle: Bundle
    artifacts: DataFrame
    graph_digest: str
    catalog_digest: str
    sets: dict[str, Intent]

    def bound(self, resolver: Resolver | None = None) -> Bundle:
        """The bundle with the addresses' status, as the resolver tells it; without one, what has a target is exact."""
        own = Resolver(self.graph_digest, self.catalog_digest)
        told = resolver or own
        if (told.graph_digest, told.catalog_digest) != (own.graph_digest, own.catalog_digest):
            raise HandoffError("the resolver is of another graph or catalog")
        marked = [(i, "forbidden") for i in told.forbidden] + [(i, "obsolete") for i in told.obsolete - told.forbidden]
        a = self.bundle.addresses.join(_frame(self.bundle.addresses.sparkSession, marked, "address_id string, marked string"), "address_id", "left")
        status = F.when(F.col("marked").isNotNull(), F.col("marked")).when(F.col("node_id").isNull() & F.col("division_id").isNull(), "unresolved").otherwise("exact")
        return replace(self.bundle, addresses=a.withColumn("status", status).drop("marked"))

    def evidence_set(self, address_id: str, intent: Intent | None = None) -> Intent:
        """The catalog's set, or the intent if the catalog has none; one that conflicts with the catalog is refused."""
        known = self.sets.get(address_id)
        if intent is not None:
            if intent.address_id != address_id:
                raise HandoffError("the intent is of another address")
            if known is not None and known != intent:
                raise HandoffError("the intent conflicts with the catalog")
            if self.bundle.addresses.where(F.col("address_id") == address_id).limit(1).count():
                raise HandoffError(f"{address_id} is another kind of address")
        found = known or intent
        if found is None:
            raise SupportError(f"no evidence set {address_id}")
        strange = set(found.member_ids) - {r.address_id for r in self.bundle.addresses.where(F.col("address_id").isin(*found.member_ids)).select("address_id").collect()}
        if len(found.claim_ids) != len(found.member_ids) or len(set(found.claim_ids)) < len(found.claim_ids) or strange:
            raise HandoffError(f"the evidence set {address_id} is incomplete")
        return found


# Loading


def _parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for content in frame["content"]:
            try:
                value, name = canonical_record(bytes(content))
                nodes = [{"node_id": n["node_id"], "resource_id": n["resource_id"], "owner_division_id": n.get("owner_division_id"), "text": n["content"]["text"]} for n in value["content_nodes"]]
                rows.append((name, nodes, [{k: r[k] for k in ("resource_id", "source_sha256")} for r in value["resources"]], None))
            except (ValueError, KeyError, TypeError) as e:
                rows.append((None, [], [], f"{type(e).__name__}: {e}"))
        yield pd.DataFrame(rows, columns=["digest", "nodes", "resources", "error"])


def canonical_artifacts(spark: SparkSession, store: ArtifactStore, uris: list[str]) -> DataFrame:
    """(digest, nodes, resources) of canonical artifacts; bytes that aren't canonical are refused."""
    files = spark.read.format("binaryFile").load([store.of(u).path(store.of(u).key(u)) for u in dict.fromkeys(uris)])
    parsed = materialize(files.select("content").mapInPandas(_parse, ARTIFACT), "artifacts")  # parsed once
    bad = parsed.where("error is not null").limit(1).collect()
    if bad:
        raise HandoffError(f"a canonical artifact can't be read: {bad[0].error}")
    return parsed.drop("error")


def _frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def load(spark: SparkSession, store: ArtifactStore, source: Source, document_id: str | None = None) -> Loaded:
    """The bundle of all documents, which must share one graph and one catalog, or of one document."""
    documents = [source.document(document_id)] if document_id else list(source.require_references())
    shared = {(d["source_graph_uri"], d["provenance_addresses_uri"]) for d in documents}
    if len(shared) != 1:
        raise HandoffError("the documents' graphs are not one; load one document")
    graph, catalog = (canonical_record(store.of(u).get(store.of(u).key(u)))[0] for u in next(iter(shared)))
    artifacts = canonical_artifacts(spark, store, [d["canonical_content_uri"] for d in documents])
    nodes = artifacts.select(F.explode("nodes").alias("n")).select("n.*")
    resources = artifacts.select(F.explode("resources").alias("r")).select("r.*")
    divisions = [(d["division_id"], pos, node) for d in graph.get("divisions", []) for pos, node in enumerate(d.get("direct_node_ids", []))]
    relations = [
        (pos, r["relation_id"], r["source_id"], r.get("target_id"), bool(r.get("gold_eligible")) and r.get("status") in VALIDATED) for pos, r in enumerate(graph.get("relations", []))
    ]
    targets = [(a, a.get("canonical_target") or {}) for a in catalog.get("strong_addresses", [])]
    addresses = [(pos, a["address_id"], a["graph_revision"], a["resource_id"], t.get("node_id"), t.get("division_id"), t.get("char_start"), t.get("char_end")) for pos, (a, t) in enumerate(targets)]
    bundle = Bundle(
        graph["graph_revision"], nodes, _frame(spark, divisions, "division_id string, pos int, node_id string"), resources,
        _frame(spark, [(r["resource_id"], r["source_sha256"]) for r in graph.get("resources", [])], "resource_id string, source_sha256 string"),
        _frame(spark, relations, RELATION), _frame(spark, addresses, ADDRESS),
    )
    sets = {s["address_id"]: Intent(s["address_id"], tuple(s["claim_ids"]), tuple(s["member_address_ids"])) for s in catalog.get("evidence_set_addresses", [])}
    bundle.validate()
    return Loaded(bundle, artifacts, digest(graph), digest(catalog), sets)


# Segmentations


def _spans(view_set: dict[str, Any]) -> Iterator[tuple]:
    for view in view_set["views"]:
        for segment in view["segments"]:
            groups = {"own": segment.get("node_spans", []), "context": segment.get("context", []), "retrieval": segment.get("retrieval_node_spans", []), "seed": [segment["seed"]] if segment.get("seed") else []}
            for kind, spans in groups.items():
                for pos, s in enumerate(spans):
                    yield view_set["canonical_content_sha256"], view["view_id"], segment["segment_id"], kind, pos, s["node_id"], s.get("char_start"), s.get("char_end")


def segments(spark: SparkSession, loaded: Loaded, view_set: dict[str, Any]) -> DataFrame:
    """(view_id, segment_id, pos, node_id, char_start, char_end) of the segments' own spans.

    The view set must be of exactly one of the bundle's artifacts, by its digest, and every span, of whatever kind, must lie in a node of
    that artifact.
    """
    spans = _frame(spark, list(_spans(view_set)), SPAN)
    if loaded.artifacts.where(F.col("digest") == view_set["canonical_content_sha256"]).count() != 1:
        raise HandoffError("the segmentation is not of exactly one canonical artifact")
    nodes = loaded.artifacts.select(F.col("digest").alias("artifact"), F.explode("nodes").alias("n")).select("artifact", "n.node_id", F.length("n.text").alias("n_chars"))
    met = spans.join(nodes, ["artifact", "node_id"], "left")
    half = F.col("char_start").isNull() != F.col("char_end").isNull()
    out = half | (F.col("char_start") < 0) | (F.col("char_start") >= F.col("char_end")) | (F.col("char_end") > F.col("n_chars"))
    bad = met.where(F.col("n_chars").isNull() | F.coalesce(out, half)).limit(1).collect()
    if bad:
        raise HandoffError(f"a segment's span is outside its content: {bad[0].view_id}, {bad[0].segment_id}, {bad[0].node_id}")
    return spans.where("kind = 'own'").drop("artifact", "kind")


def spans_of(found: DataFrame, view_id: str, segment_id: str) -> DataFrame:
    """One segment's spans, as build_paragraph takes them."""
    return found.where((F.col("view_id") == view_id) & (F.col("segment_id") == segment_id)).drop("view_id", "segment_id")
