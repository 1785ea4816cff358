"""Provenance documents as tables: one distributed read of all of them, and joins and aggregates instead of loops over documents.

A document is a VARIANT, so that fields that we don't know don't matter. What doesn't fit is a row of `problems`; the driver gets the first
one. Only the documents' addresses, which the manifest lists, go through the driver, as the reader needs them.
"""

from __future__ import annotations

from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .manifest import PROVENANCE_SCHEMA, PROVENANCE_VERSIONS, REFERENCE_FIELDS, SourceError, parse_reference
from .store import ArtifactStore

#: Where a derived reference's fields are in a document; its own address is no part of it.
DERIVED = {"document_id": "$.document_id", "canonical_content_uri": "$.artifact_uris.canonical_content", "source_graph_uri": "$.artifact_uris.source_graph", "provenance_addresses_uri": "$.artifact_uris.provenance_addresses"}
#: The version of a document from which a reference follows.
DERIVES = "2"


def text_at(path: str, doc: str = "doc") -> Column:
    return F.try_variant_get(doc, path, "string")


def read_documents(spark: SparkSession, store: ArtifactStore, uris: list[str]) -> DataFrame:
    """(uri, doc) of the documents; doc is null if a file isn't JSON."""
    listed = spark.createDataFrame([(u, store.of(u).path(store.of(u).key(u))) for u in uris], "uri string, path string")
    try:
        files = spark.read.format("binaryFile").load([r.path for r in listed.select("path").distinct().collect()])
    except AnalysisException as e:
        raise SourceError(f"a provenance document isn't there: {e}") from e
    local = lambda c: F.regexp_replace(c, "^file:/+", "/")
    found = files.select(local(F.col("path")).alias("path"), F.try_parse_json(F.decode("content", "UTF-8")).alias("doc"))
    return listed.withColumn("path", local(F.col("path"))).join(found, "path", "left").select("uri", "doc")


def described(documents: DataFrame) -> DataFrame:
    """documents with the fields that are checked; a missing id is null."""
    fields = {"schema": "$.schema", "version": "$.schema_version", "document_id": "$.document_id", "asset_id": "$.source_asset.asset_id", "sha256": "$.source_asset.blob_sha256"}
    return documents.select("*", *[text_at(path).alias(name) for name, path in fields.items()])


def problems(documents: DataFrame, known: DataFrame, assets: DataFrame | None) -> DataFrame:
    """(problem, id) of all that doesn't fit; empty for good provenance.

    documents: (uri, doc). known: (document_id) that the manifest lists; if it lists none, none can be covered, and documents are refused, too. assets:
    (asset_id, sha256), None if the manifest lists none, in which case documents can name any; an asset without a hash holds for any content.
    """
    rows = described(documents)
    told = lambda df, problem, column: df.select(F.lit(problem).alias("problem"), F.col(column).cast("string").alias("id"))
    listed = known.select("document_id").distinct()
    parts = [
        told(rows.where("doc is null"), "not_json", "uri"),
        told(rows.where(F.col("doc").isNotNull() & ~F.col("schema").eqNullSafe(PROVENANCE_SCHEMA)), "schema_unknown", "uri"),
        told(rows.where(F.col("doc").isNotNull() & ~F.coalesce(F.col("version").isin(*PROVENANCE_VERSIONS), F.lit(False))), "version_unknown", "uri"),
        told(rows.where(F.col("doc").isNotNull() & (F.coalesce("document_id", F.lit("")) == "")), "id_missing", "uri"),
        told(rows.where("document_id <> ''").groupBy("document_id").count().where("count > 1"), "document_repeated", "document_id"),
        told(rows.where("document_id <> ''").join(listed, "document_id", "left_anti"), "document_unknown", "document_id"),
        told(listed.join(rows.select("document_id").where("document_id is not null"), "document_id", "left_anti"), "document_uncovered", "document_id"),
    ]
    if assets is not None:
        met = rows.where("doc is not null").join(assets.select("asset_id", F.col("sha256").alias("known_sha256"), F.lit(True).alias("is_known")), "asset_id", "left")
        differs = F.col("known_sha256").isNotNull() & (F.col("known_sha256") != "") & ~F.col("sha256").eqNullSafe(F.col("known_sha256"))
        parts += [told(met.where("is_known is null"), "asset_unknown", "document_id"), told(met.where(differs), "content_differs", "document_id")]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def anchors(documents: DataFrame) -> DataFrame:
    """(evidence_id, anchors): an evidence's distinct anchors and blocks in their document's order; of several documents the one with the greatest id counts."""
    spark = documents.sparkSession
    rows = described(documents).select("document_id", F.try_variant_get("doc", "$.evidence", "variant").alias("evidence"))
    each = spark.sql("SELECT document_id, e.pos, e.value AS item FROM {rows}, LATERAL variant_explode(evidence) AS e", rows=rows)
    each = each.select("document_id", "pos", text_at("$.evidence_id", "item").alias("evidence_id"), F.array(text_at("$.anchor_id", "item"), text_at("$.block_id", "item")).alias("both")).where("evidence_id is not null")
    ordered = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("pos", "both"))), lambda x: x["both"]))
    by_document = each.groupBy("document_id", "evidence_id").agg(F.array_distinct(F.filter(ordered, lambda a: a != "")).alias("found"))
    return by_document.groupBy("evidence_id").agg(F.max_by("found", "document_id").alias("anchors"))


def derived(documents: DataFrame) -> DataFrame:
    """The references that documents of the second version imply, where all of their fields are there."""
    rows = documents.where(text_at("$.schema_version") == DERIVES).select(F.col("uri").alias("provenance_uri"), *[text_at(path).alias(name) for name, path in DERIVED.items()])
    whole = F.lit(True)
    for name in REFERENCE_FIELDS:
        whole = whole & (F.coalesce(name, F.lit("")) != "")
    return rows.where(whole).select(*REFERENCE_FIELDS)


def reference_problems(direct: DataFrame, documents: DataFrame) -> DataFrame:
    """(problem, id) of direct references against the documents and the references that follow from them."""
    told = lambda df, problem: df.select(F.lit(problem).alias("problem"), F.col("document_id").alias("id"))
    ids = documents.select(text_at("$.document_id").alias("document_id")).where("document_id is not null")
    own, other = direct.alias("d"), derived(documents).alias("o")
    same = F.lit(True)
    for name in REFERENCE_FIELDS:
        same = same & F.col(f"d.{name}").eqNullSafe(F.col(f"o.{name}"))
    conflicts = own.join(other, F.col("d.document_id") == F.col("o.document_id")).where(~same).select("d.document_id")
    return (
        told(direct.groupBy("document_id").count().where("count > 1"), "reference_repeated")
        .unionByName(told(ids.join(direct, "document_id", "left_anti"), "document_unreferenced"))
        .unionByName(told(direct.join(ids, "document_id", "left_anti"), "reference_unproven"))
        .unionByName(told(conflicts, "reference_conflicts"))
    )


def in_order(references: DataFrame) -> DataFrame:
    """References with the JSON text that they are ordered by."""
    return references.select(*REFERENCE_FIELDS, F.to_json(F.struct(*sorted(REFERENCE_FIELDS))).alias("json"))


def require_none(found: DataFrame) -> None:
    first = found.limit(1).collect()
    if first:
        raise SourceError(f"{first[0].problem}: {first[0].id}")


def tables(spark: SparkSession, store: ArtifactStore, manifest: dict[str, Any]) -> tuple[DataFrame | None, DataFrame | None]:
    """(documents, references) of a run manifest, checked; None where it has none. References are direct ones, or all derived ones."""
    uris = list(dict.fromkeys(manifest.get("provenance_refs") or ()))
    if not uris:
        return None, None
    if len(uris) < len(manifest["provenance_refs"]):
        raise SourceError("a provenance document is listed twice")
    documents = read_documents(spark, store, uris)
    known = spark.createDataFrame([(d,) for d in manifest.get("document_ids") or ()], "document_id string")
    listed = [(a["asset_id"], a.get("sha256")) for a in manifest.get("source_assets") or () if a.get("asset_id")]
    require_none(problems(documents, known, spark.createDataFrame(listed, "asset_id string, sha256 string") if listed else None))
    given = manifest.get("source_refs")
    if given is None:
        found = derived(documents)
        return documents, found if found.count() == len(uris) else None
    direct = spark.createDataFrame([tuple(parse_reference(x)[f] for f in REFERENCE_FIELDS) for x in given], ", ".join(f"{f} string" for f in REFERENCE_FIELDS))
    require_none(reference_problems(direct, documents))
    return documents, direct
