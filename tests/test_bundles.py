import json

import pytest

from passagemill.operators import bundles as L
from passagemill.operators import handoff as H
from passagemill.sources.manifest import Source
from passagemill.sources.store import ArtifactStore, canonical_json


def artifact(*nodes, resource="R"):
    return {"resources": [{"resource_id": resource, "source_sha256": f"h{resource}"}], "content_nodes": [{"node_id": n, "resource_id": resource, "owner_division_id": "s", "content": {"text": t}} for n, t in nodes]}


def graph(*resources):
    edges = [{"relation_id": "r0", "source_id": "n1", "target_id": "s2", "status": "validated", "gold_eligible": True}, {"relation_id": "r1", "source_id": "n1", "target_id": "s3", "status": "proposed", "gold_eligible": True}]
    return {"graph_revision": "g1", "resources": [{"resource_id": r, "source_sha256": f"h{r}"} for r in resources], "divisions": [{"division_id": "s1", "direct_node_ids": ["n1"]}, {"division_id": "s2", "direct_node_ids": ["m1"]}], "relations": edges}


def catalog(*targets):
    strong = [{"address_id": f"A{i}", "graph_revision": "g1", "resource_id": r, "canonical_target": t} for i, (r, t) in enumerate(targets)]
    return {"strong_addresses": strong, "evidence_set_addresses": [{"address_id": "set", "claim_ids": ["c1", "c2"], "member_address_ids": ["A0", "A1"]}]}


TARGETS = [("R", {"node_id": "n1"}), ("S", {"node_id": "m1"}), ("R", {"node_id": "n1", "char_start": 0, "char_end": 4})]


@pytest.fixture
def stored(tmp_path):
    store = ArtifactStore(str(tmp_path))
    values = {"c1": artifact(("n1", "Rule text."), ("n2", "More.")), "c2": artifact(("m1", "Exception."), resource="S"), "g": graph("R", "S"), "p": catalog(*TARGETS), "g-one": graph("R"), "p-one": catalog(TARGETS[0])}
    for name, value in values.items():
        store.put(name, canonical_json(value))
    reference = lambda d, c, g="g", p="p": {"document_id": d, "provenance_uri": "u", "canonical_content_uri": store.uri(c), "source_graph_uri": store.uri(g), "provenance_addresses_uri": store.uri(p)}
    return store, values, reference


class Echo:
    generate = staticmethod(lambda text: (f"What is {text}?", text[:9]))
    claim = staticmethod(lambda text: f"claim: {text}")


def test_a_bundle_of_many_documents(spark, stored):
    store, values, reference = stored
    loaded = L.load(spark, store, Source({}, (), (reference("d1", "c1"), reference("d2", "c2"))))
    views = {"canonical_content_sha256": L.digest(values["c1"]), "views": [{"view_id": "v", "segments": [{"segment_id": "x", "node_spans": [{"node_id": "n1", "char_start": 0, "char_end": 4}], "context": [{"node_id": "n2"}], "seed": {"node_id": "n1"}}]}]}
    spans = L.spans_of(L.segments(spark, loaded, views), "v", "x")
    assert H.build_paragraph(loaded.bound(), "v", "x", spans, Echo()).question == "What is Rule?"
    found = loaded.evidence_set("set")
    got = H.build_composite(loaded.bound(), "s1", "set", list(found.claim_ids), list(found.member_ids), Echo())
    assert [c.text for c in got.claims] == ["claim: Rule text.", "claim: Exception."] and (got.allowed_relations, got.excluded_relations) == (("r0",), ("r1",))

    for change in ({"canonical_content_sha256": "other"}, {"views": [{"view_id": "v", "segments": [{"segment_id": "x", "context": [{"node_id": "m1"}]}]}]}, {"views": [{"view_id": "v", "segments": [{"segment_id": "x", "retrieval_node_spans": [{"node_id": "n2", "char_start": 0, "char_end": 99}]}]}]}, {"views": [{"view_id": "v", "segments": [{"segment_id": "x", "seed": {"node_id": "n2", "char_start": 1}}]}]}):
        with pytest.raises(H.HandoffError):
            L.segments(spark, loaded, views | change)

    policy = L.Resolver(loaded.graph_digest, loaded.catalog_digest, forbidden=frozenset({"A1"}), obsolete=frozenset({"A2"}))
    with pytest.raises(H.SupportError, match="forbidden"):
        H.build_composite(loaded.bound(policy), "s1", "set", ["c1", "c2"], ["A0", "A1"], Echo())
    with pytest.raises(H.SupportError, match="obsolete"):
        H.build_paragraph(loaded.bound(policy), "v", "x", spans, Echo())
    with pytest.raises(H.HandoffError, match="another graph"):
        loaded.bound(L.Resolver("x", loaded.catalog_digest))

    intent = L.Intent("new", ("c",), ("A0",))
    assert loaded.evidence_set("new", intent) == intent
    with pytest.raises(H.SupportError):
        loaded.evidence_set("new")
    for name, other in (("set", L.Intent("set", ("c",), ("A0",))), ("new", L.Intent("new", ("c",), ("A9",))), ("x", intent), ("A0", L.Intent("A0", ("c",), ("A1",)))):
        with pytest.raises(H.HandoffError):
            loaded.evidence_set(name, other)


def test_one_document_and_refusals(spark, stored, tmp_path):
    store, values, reference = stored
    source = Source({}, (), (reference("d1", "c1", "g-one", "p-one"), reference("d2", "c2")))
    assert L.load(spark, store, source, "d1").bundle.nodes.count() == 2
    with pytest.raises(H.HandoffError, match="not one"):
        L.load(spark, store, source)
    with pytest.raises(H.HandoffError):  # the graph tells of a resource that isn't there
        L.load(spark, store, Source({}, (), (reference("d1", "c1"),)))
    store.put("loose", json.dumps(values["c1"], indent=1).encode())
    with pytest.raises(H.HandoffError, match="canonical"):
        L.load(spark, store, Source({}, (), (reference("d1", "loose", "g-one", "p-one"),)))
    with pytest.raises(H.HandoffError, match="identity"):
        H.put(store, "a b", H.ParagraphHandoff("v", "s", "q", "a", ("A",)))
