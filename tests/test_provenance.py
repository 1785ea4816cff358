"""Provenance as tables against the driver's way, and through a source that is resolved."""

import json

import pytest

from passagemill.sources import manifest as S
from passagemill.sources import provenance as P
from passagemill.sources.store import ArtifactStore, canonical_json

RUN = {"schema": S.RUN_SCHEMA, "run_id": "r", "context_id": "c", "evidence_refs": []}


def document(name, asset="a", sha="s", version="2", **more):
    uris = {"canonical_content": f"{name}1", "source_graph": "g", "provenance_addresses": "p"}
    return {"schema": S.PROVENANCE_SCHEMA, "schema_version": version, "document_id": name, "source_asset": {"asset_id": asset, "blob_sha256": sha}, "artifact_uris": uris, **more}


def stored(tmp_path, documents, **manifest):
    store = ArtifactStore(str(tmp_path))
    refs = [store.put(f"prov/{i} ü.json", canonical_json(d) if isinstance(d, dict) else d) for i, d in enumerate(documents)]
    value = RUN | {"provenance_refs": refs, "document_ids": sorted({d["document_id"] for d in documents if isinstance(d, dict) and "document_id" in d})} | manifest
    return store, store.put_json("run.json", value), refs


GOOD = [document("d2"), document("d1"), document("d3", "b", "t")]
ASSETS = [{"asset_id": "a", "sha256": "s"}, {"asset_id": "b"}, {"name": "without an id"}]
BAD = {
    "another schema": ([document("d1", schema="x")], {}),
    "no schema": ([{k: v for k, v in document("d1").items() if k != "schema"}], {}),
    "version": ([document("d1", version="3")], {}),
    "no id": ([document("d1"), document("")], {"document_ids": ["d1"]}),
    "repeated": ([document("d1"), document("d1", more=1)], {}),
    "unknown": ([document("d1")], {"document_ids": ["other"]}),
    "not covered": ([document("d1")], {"document_ids": ["d1", "d2"]}),
    "nothing listed": ([document("d1")], {"document_ids": []}),
    "unknown asset": ([document("d1", asset="z")], {}),
    "other content": ([document("d1", sha="z")], {}),
}


@pytest.mark.parametrize("case", BAD)
def test_both_ways_refuse(spark, tmp_path, case):
    documents, manifest = BAD[case]
    store, uri, _ = stored(tmp_path, documents, **{"source_assets": ASSETS, **manifest})
    for session in (None, spark):
        with pytest.raises(S.SourceError):
            S.resolve(store, uri, session)


def test_what_the_tables_alone_refuse(spark, tmp_path):
    store, uri, refs = stored(tmp_path, [document("d1"), b"{"], document_ids=["d1"])
    with pytest.raises(S.SourceError, match="not_json"):
        S.resolve(store, uri, spark)
    store.put_json("twice.json", RUN | {"provenance_refs": [refs[0], refs[0]], "document_ids": ["d1"]})
    with pytest.raises(S.SourceError, match="twice"):
        S.resolve(store, store.uri("twice.json"), spark)
    store.put_json("lost.json", RUN | {"provenance_refs": [store.uri("nowhere.json")], "document_ids": ["d1"]})
    with pytest.raises(S.SourceError, match="isn't there"):
        S.resolve(store, store.uri("lost.json"), spark)


def test_both_ways_agree(spark, tmp_path):
    for n, manifest in enumerate(({"source_assets": ASSETS}, {}, {"source_assets": []})):
        store, uri, refs = stored(tmp_path / str(n), GOOD, **manifest)
        one, other = S.resolve(store, uri), S.resolve(store, uri, spark)
        assert one.checksum == other.checksum and [d["document_id"] for d in one.provenance] == ["d1", "d2", "d3"]
        for name in ("d1", "d2", "d3"):
            assert one.document(name) == other.document(name)
        assert [canonical_json(r).decode().strip() for r in one.references] == [r.json for r in P.in_order(other.reference_table).orderBy("json").collect()]
        with pytest.raises(S.SourceError):
            other.document("d9")
    assert S.resolve(store, store.put_json("bare.json", RUN), spark).reference_table is None


def test_direct_references(spark, tmp_path):
    _, _, refs = stored(tmp_path / "refs", GOOD)
    derived = [{"document_id": d["document_id"], "provenance_uri": u, "canonical_content_uri": d["artifact_uris"]["canonical_content"], "source_graph_uri": "g", "provenance_addresses_uri": "p"} for d, u in zip(GOOD, refs)]
    cases = {"good": (derived, None), "few": (derived[:2], "unreferenced"), "more": ([*derived, derived[0] | {"document_id": "d9"}], "unproven"), "twice": ([*derived, derived[0]], "repeated"), "other": ([derived[0] | {"source_graph_uri": "x"}, *derived[1:]], "conflicts")}
    for name, (direct, problem) in cases.items():
        store, uri, _ = stored(tmp_path / name, GOOD, source_refs=direct)
        if problem:
            with pytest.raises(S.SourceError, match=problem):
                S.resolve(store, uri, spark)
            with pytest.raises(S.SourceError):
                S.resolve(store, uri)
        else:
            assert S.resolve(store, uri, spark).document("d1") == derived[1]
            # in the order of their JSON texts, whose first field is the content's address
            assert [r["document_id"] for r in S.resolve(store, uri).references] == ["d1", "d2", "d3"]
    store, uri, _ = stored(tmp_path / "old", [document("d1", version="1"), document("d2")])
    assert S.resolve(store, uri, spark).reference_table is None and S.resolve(store, uri).references == ()


def test_anchors_of_the_last_document(spark, tmp_path):
    item = lambda e, a, b=None: {"evidence_id": e, "anchor_id": a, "block_id": b}
    documents = [document("d1", evidence=[item("e1", "x"), item("e2", "y", "z")]), document("d2", evidence=[item("e1", "q", "r"), item("e1", "p"), item("e1", "q"), {"other": 1}]), document("d3", evidence=None), document("d4")]
    store, uri, _ = stored(tmp_path, documents)
    got = {r.evidence_id: tuple(r.anchors) for r in P.anchors(S.resolve(store, uri, spark).documents).collect()}
    assert got == {"e1": ("q", "r", "p"), "e2": ("y", "z")}
