import json

import pytest
from pyspark.sql import functions as F

from passagemill.operators import clients
from passagemill.operators import evalsets as E
from passagemill.operators import graph as G
from passagemill.operators import handoff as H
from passagemill.operators import responder as M
from passagemill.plans import build as B
from passagemill.plans import cli
from passagemill.plans import config as C
from passagemill.plans import recipes, render
from passagemill.sources import manifest as S
from passagemill.sources.store import ArtifactStore, StoreConflict, canonical_record, canonical_json

TOML = '[models.generator]\nmodel = "m"\n'


def evidence(spark, n=4):
    rows = [(f"e{i}", f"d{i}", f"a{i % 2}", "r", "c", None, 1, f"First passage {i % 3}.\n\nSecond passage number {i}. More.", 0, "s") for i in range(n)]
    return spark.createDataFrame(rows, "evidence_id string, document_id string, source_asset_id string, run_id string, context_id string, sequence_number long, page_number int, text string, char_start int, source_sha256 string")


@pytest.mark.parametrize("recipe", recipes.RECIPES)
def test_recipes_publish_once(spark, tmp_path, recipe):
    store, config = ArtifactStore(str(tmp_path)), C.parse(TOML)
    got = B.build(spark, store, evidence(spark), recipe, config, "demo", "source", run_id="run-1")
    rows = store.shard_rows(got["record_shards"])
    assert not got["reused"] and len(rows) == got["accepted_count"] > 0
    assert [r["ordinal"] for r in rows] == list(range(len(rows)))
    assert len({json.dumps(r["messages"]) for r in rows}) == len(rows)
    again = B.build(spark, store, evidence(spark), recipe, config, "demo", "source", run_id="run-2")
    assert again["reused"] and again["records_checksum"] == got["records_checksum"]
    assert got["stages"] == again["stages"] and got["call_count"] > 0 and {"records", "rejections"} <= set(got["stages"])
    (tmp_path / store.key(got["record_shards"][0]["uri"])).write_bytes(b"{}\n")
    with pytest.raises(StoreConflict):
        B.build(spark, store, evidence(spark), recipe, config, "demo", "source", run_id="run-3")


class Failing:
    def respond(self, role, messages):
        if "number 2" in messages[-1]["content"]:
            raise RuntimeError("connection lost")
        return M.DeterministicResponder().respond(role, messages)


def test_a_failed_call_is_a_rejection(spark, tmp_path):
    got = B.build(spark, ArtifactStore(str(tmp_path)), evidence(spark), "paragraph-qa", C.parse(TOML), "demo", "s", factory=Failing)
    assert got["rejected_count"] == 1


def test_cancel_publishes_nothing(spark, tmp_path):
    store = ArtifactStore(str(tmp_path))
    B.request_cancel(store, B.make_id("job", "run-9"))
    with pytest.raises(B.Cancelled):
        B.build(spark, store, evidence(spark), "paragraph-qa", C.parse(TOML), "demo", "s", run_id="run-9")
    assert not list(tmp_path.rglob("manifest.json")) and list(tmp_path.rglob("events-*.jsonl"))


def test_policy_comes_before_any_call(spark, tmp_path):
    config = C.parse('[models.generator]\nmodel = "m"\nprovider = "far"\n[data]\nclassification = "confidential"\n')
    with pytest.raises(M.ProviderBlocked):
        B.build(spark, ArtifactStore(str(tmp_path)), evidence(spark), "v0", config, "demo", "s")
    with pytest.raises(M.TokenBudgetExceeded):
        M.check_budget(10, 5, 12)


def test_config_and_rendering(capsys, tmp_path):
    config = C.parse(TOML + '[models.validator]\nmodel = "v"\n')
    assert (config.model("probe_judge")["model"], config.model("qa_generator")["model"]) == ("v", "m")
    assert C.redact({"api_key": "x", "max_output_tokens": 3, "uri": "s3://u:p@h/k?sig=1"}) == {"api_key": C.REDACTED, "max_output_tokens": C.REDACTED, "uri": f"s3://{C.REDACTED}@h/k?{C.REDACTED}"}
    (tmp_path / "bad.toml").write_text("x = ")
    (tmp_path / "good.toml").write_text(TOML)
    assert cli.main(["config", "validate", "--config", str(tmp_path / "bad.toml")]) == 2
    assert cli.main(["--human", "config", "show", "--config", str(tmp_path / "good.toml")]) == 0
    assert "Models" in capsys.readouterr().out and "A b" in render.human({"a_b": [{"c": 1}]})


def test_evaluation_sets_and_packages(tmp_path):
    store = ArtifactStore(str(tmp_path))
    exact = E.freeze(store, [{"record_id": "x", "source_record_id": "y"}], "set", "exact_recall")
    assert E.freeze(store, [{"record_id": "x", "source_record_id": "y"}], "set", "exact_recall")["version"] == exact["version"]
    para = E.freeze(store, [{"record_id": "p", "fact_group_id": "g", "record_provenance": {"a": 1}}], "set", "paraphrase_evaluation")
    package = E.create_package(store, "pack", {"uri": "u"}, [para["uri"], exact["uri"]])
    assert E.load_package(store, package["uri"])["version"] == package["version"]
    for rows, role in (([], "exact_recall"), ([{"record_id": "a"}], "exact_recall"), ([{"record_id": "a", "source_record_id": "b", "training_eligible": True}], "exact_recall"), ([{"record_id": "a", "source_record_id": "b"}] * 2, "exact_recall"), ([{"record_id": "a", "fact_group_id": "g"}], "paraphrase_evaluation")):
        with pytest.raises(ValueError):
            E.freeze(store, rows, "bad", role)
    with pytest.raises(ValueError):
        E.create_package(store, "pack", {}, [para["uri"]])
    (tmp_path / store.key(exact["records_uri"])).write_text("{}\n")
    with pytest.raises((StoreConflict, KeyError, ValueError)):
        E.load_package(store, package["uri"])


def test_canonical_records_and_store(tmp_path):
    store = ArtifactStore(str(tmp_path))
    assert store.put("k/a", b"1") == store.put("k/a", b"1")
    with pytest.raises(StoreConflict):
        store.put("k/a", b"2")
    with pytest.raises(ValueError):
        store.key("storage://shared/../x")
    assert canonical_record(canonical_json({"b": 1, "a": "é"}))[0] == {"a": "é", "b": 1}
    for bad in (b'{"a":1,"a":2}\n', b'{"a":NaN}\n', b'{"a": 1}\n', b"[1]\n"):
        with pytest.raises(ValueError):
            canonical_record(bad)


def test_references():
    manifest = {"document_ids": ["d"], "source_assets": [{"asset_id": "a", "sha256": "s"}]}
    doc = {"schema": "ingest-provenance", "schema_version": "2", "document_id": "d", "uri": "u", "source_asset": {"asset_id": "a", "blob_sha256": "s"}, "artifact_uris": {"canonical_content": "1", "source_graph": "2", "provenance_addresses": "3"}}
    proven = S.check_provenance([doc], manifest)
    derived = S.references(manifest, proven)
    assert S.references(manifest | {"source_refs": [dict(derived[0])]}, proven) == derived
    with pytest.raises(S.SourceError):
        S.references(manifest | {"source_refs": [derived[0] | {"source_graph_uri": "other"}]}, proven)
    with pytest.raises(S.SourceError):
        S.check_provenance([doc, doc], manifest)
    assert S.references(manifest, ({**doc, "schema_version": "1"},)) == ()


def bundle(spark, **change):
    frames = {
        "nodes": ([("n1", "R", "s1", "Rule text."), ("n2", "R", "s2", "Exception text."), ("n3", "R", "s3", "Far text.")], "node_id string, resource_id string, owner_division_id string, text string"),
        "divisions": ([("s1", 0, "n1"), ("s2", 0, "n2"), ("s3", 0, "n3")], "division_id string, pos int, node_id string"),
        "resources": ([("R", "h")], "resource_id string, source_sha256 string"),
        "graph_resources": ([("R", "h")], "resource_id string, source_sha256 string"),
        "relations": ([(0, "r0", "n1", "s2", True), (1, "r1", "n2", "s1", True), (2, "r2", "n1", None, True), (3, "r3", "n1", "s3", False)], "pos int, relation_id string, source_id string, target_id string, gold_eligible boolean"),
        "addresses": ([(i, f"A{i}", "g1", "R", f"n{i}", None, None, None, "exact") for i in (1, 2, 3)] + [(4, "A4", "g1", "R", "n1", None, 0, 4, "exact"), (5, "A5", "g1", "R", None, "s2", None, None, "obsolete")], "pos int, address_id string, graph_revision string, resource_id string, node_id string, division_id string, char_start int, char_end int, status string"),
    }
    return H.Bundle("g1", **{k: spark.createDataFrame(change.get(k, rows), kind) for k, (rows, kind) in frames.items()})


class Echo:
    calls = 0

    def generate(self, text):
        Echo.calls += 1
        return f"What is {text}?", text[:9]

    claim = staticmethod(lambda text: f"claim: {text}")


def test_handoffs(spark, tmp_path):
    b = bundle(spark)
    span = spark.createDataFrame([(0, "n1", 0, 4), (1, "n2", None, None)], "pos int, node_id string, char_start int, char_end int")
    got = H.build_paragraph(b, "v", "seg", span, Echo())
    assert got.support_ids == ("A4", "A2") and got.question == "What is Rule\nException text.?"
    composite = H.build_composite(b, "s1", "set", ["c1", "c2"], ["A1", "A2"], Echo())
    assert [c.text for c in composite.claims] == ["claim: Rule text.", "claim: Exception text."]
    assert (composite.allowed_relations, composite.excluded_relations) == (("r0", "r1"), ("r2", "r3"))
    store = ArtifactStore(str(tmp_path))
    assert H.put(store, "one", got) == H.put(store, "one", got)
    with pytest.raises(StoreConflict):
        H.put(store, "one", H.ParagraphHandoff("v", "seg", "q", "a", ("A1",)))
    with pytest.raises(H.HandoffError):
        H.put(store, "two", {"question": "q"})


def test_no_generation_before_the_proofs(spark):
    b, before = bundle(spark), Echo.calls
    with pytest.raises(H.SupportError):  # not reached from the seed
        H.build_composite(b, "s1", "set", ["c"], ["A3"], Echo())
    with pytest.raises(H.SupportError):  # obsolete
        H.build_composite(b, "s1", "set", ["c"], ["A5"], Echo())
    with pytest.raises(H.SupportError):  # a missing offset is not any offset
        H.build_paragraph(b, "v", "s", spark.createDataFrame([(0, "n2", 0, 4)], "pos int, node_id string, char_start int, char_end int"), Echo())
    for change in ({"graph_resources": [("R", "other")]}, {"addresses": [(1, "A1", "g2", "R", "n1", None, None, None, "exact")]}, {"addresses": [(1, "A1", "g1", "R", "n1", None, 0, 99, "exact")]}):
        with pytest.raises(H.HandoffError):
            H.build_paragraph(bundle(spark, **change), "v", "s", spark.createDataFrame([(0, "n1", None, None)], "pos int, node_id string, char_start int, char_end int"), Echo())
    assert Echo.calls == before
    with pytest.raises(H.HandoffError):
        H.ParagraphHandoff("v", "s", "q", "a", ("A", "A")).validate()
    with pytest.raises(H.HandoffError):
        H.CompositeHandoff("s", "e", (H.Claim("c", "t", "a"),), ("r",), ("r",)).validate()


def test_closure_of_a_cycle(spark):
    edges = spark.createDataFrame([("a", "b", True), ("b", "c", True), ("c", "a", True), ("c", "d", False), ("d", "e", True)], "source_id string, target_id string, gold_eligible boolean")
    got = G.closure(edges, spark.createDataFrame([("a",)], "vertex string"))
    assert {(r.vertex, r.depth) for r in got.collect()} == {("a", 0), ("b", 1), ("c", 2)}
    assert [r.vertex for r in G.unreachable(spark.createDataFrame([("e",), ("b",)], "vertex string"), got).collect()] == ["e"]


def test_watching_a_job(spark, tmp_path):
    from passagemill.streaming.jobs import watch

    (tmp_path / "log").mkdir()
    rows = [{"job_id": "j", "sequence": i, "event": "stage", "at": f"2026-01-01T00:00:0{i}Z", "payload": "{}"} for i in (1, 2, 3)]
    (tmp_path / "log" / "a.jsonl").write_text("".join(json.dumps(r) + "\n" for r in [*rows, rows[2]]))
    query = watch(spark, str(tmp_path / "log"), 1).writeStream.format("memory").queryName("events_seen").option("checkpointLocation", str(tmp_path / "ck")).start()
    query.processAllAvailable()
    query.stop()
    assert sorted(r.sequence for r in spark.table("events_seen").collect()) == [2, 3]
    assert F is not None


class Watcher(M.DeterministicResponder):
    """Keeps what students and validators are shown."""

    def respond(self, role, messages):
        text = messages[-1]["content"]
        if role == "student" and "EVIDENCE" in text:
            raise TypeError("a student sees evidence")
        if role == "probe_judge" and "number 1" in text:
            return '{"class": "odd", "reference_answer": "x"}'
        if role == "probe_judge":
            return '{"class": "unknown", "reference_answer": "x"}'
        return super().respond(role, messages)


def test_probed_recipe_asks_its_models(spark, tmp_path):
    store = ArtifactStore(str(tmp_path))
    got = B.build(spark, store, evidence(spark), "knowledge-unit-probed-qa", C.parse(TOML + "[probing]\nprobes_per_unit = 2\n"), "demo", "s", factory=Watcher)
    rows = store.shard_rows(got["record_shards"])
    assert rows and all(r["metadata"]["probe_class"] == "unknown" and r["metadata"]["student_response_id"] and r["metadata"]["recipe"] == "knowledge-unit-probed-qa" for r in rows)
    assert got["reason_counts"]["invalid_response"] > 0 and got["inference_failure_count"] > 0
    assert {"discovery", "probes", "student", "judgment", "selection", "qa_generation", "validation"} <= set(got["stages"])


class Lost(M.DeterministicResponder):
    asked = 0

    def respond(self, role, messages):
        if role == "qa_generator" and "number 2" in messages[-1]["content"]:
            raise RuntimeError("connection lost")
        return super().respond(role, messages)


def test_a_lost_network_ends_the_unit_recipe_and_a_resumed_build_goes_on(spark, tmp_path):
    store, config = ArtifactStore(str(tmp_path)), C.parse("resume_parts = 3\n" + TOML)
    with pytest.raises(Exception, match="connection lost"):
        B.build(spark, store, evidence(spark), "knowledge-unit-qa", config, "demo", "s", run_id="run-1", factory=Lost)
    done = sorted(p.name for p in tmp_path.rglob("checkpoints/*.json"))
    assert "discovery-0.json" in done and not list(tmp_path.rglob("manifest.json"))
    written = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("stages/discovery-*/table/*.parquet")}
    got = B.build(spark, store, evidence(spark), "knowledge-unit-qa", config, "demo", "s", run_id="run-2")
    assert got["accepted_count"] > 0 and {p: p.stat().st_mtime_ns for p in written} == written
    events = [json.loads(p.read_text()) for p in sorted(tmp_path.rglob("events-run-1-*.jsonl"))]
    assert [e["sequence"] for e in events] == list(range(1, len(events) + 1)) and events[-1]["event"] == "failed"


def test_records_tell_where_they_come_from(spark, tmp_path):
    rows = evidence(spark).withColumn("anchor_id", F.concat(F.lit("p"), "evidence_id")).withColumn("block_id", F.lit(""))
    store, config = ArtifactStore(str(tmp_path)), C.parse(TOML)
    got = B.build(spark, store, rows, "paragraph-qa", config, "demo", "s", experiment=None)
    published = store.shard_rows(got["record_shards"])
    assert all(r["metadata"]["source_anchor_ids"] == ["p" + r["metadata"]["evidence_ids"][0]] and r["metadata"]["enrichment_id"].startswith("enr-") for r in published)
    assert len({r["metadata"]["enrichment_id"] for r in published}) == 4
    assert got["records_uri"] == store.uri(f"{got['dataset_id']}/{got['dataset_version']}/records")
    ids = [r.enrichment_id for r in S.enrichment_id(spark.createDataFrame([(["a", "b"], ["x"]), (["b", "a", "a"], ["x"]), (["b"], ["x"])], "h array<string>, a array<string>"), "h", "a", "m").collect()]
    assert ids[0] == ids[1] != ids[2]


def test_handoffs_ask_models(spark):
    class Model:
        respond = staticmethod(lambda role, messages: json.dumps({"instruction": "q", "answer": messages[1]["content"]}) if role == "generator" else " a claim ")

    pool = clients.Pool(Model)
    assert H.ModelQuestions(pool, clients.Role("generator")).generate("t") == ("q", "t") and H.ModelClaims(pool, clients.Role("claim")).claim("t") == "a claim"


def test_from_build_to_package_on_the_command_line(spark, tmp_path, capsys):
    store = ArtifactStore(str(tmp_path / "s"))
    got = B.build(spark, store, evidence(spark, 20), "paragraph-qa", C.parse(TOML), "demo", "s")
    uri = store.uri(got["records_uri"].removeprefix("storage://shared/").removesuffix("records") + "manifest.json")
    call = lambda *args: (cli.main(["--store", str(tmp_path / "s"), *args], spark), capsys.readouterr().out)
    told = json.loads(call("evaluation-set", "exact-recall", "--dataset", uri, "--name", "x")[1])
    assert told["record_count"] == got["train_count"] and told["record_shards"]
    assert json.loads(call("evaluation-set", "exact-recall", "--dataset", uri, "--name", "x")[1])["version"] == told["version"]
    rows = store.shard_rows(told["record_shards"])
    assert all(r["split"] == "evaluation" and r["metadata"]["training_eligible"] is False and r["metadata"]["research_role"] == "exact_recall" and r["source_record_id"] for r in rows)
    package = json.loads(call("research-package", "create", "--dataset", uri, "--name", "p", "--set", told["uri"])[1])
    assert json.loads(call("research-package", "show", package["uri"])[1])["version"] == package["version"]
    assert call("dataset", "export", uri, "--to", str(tmp_path / "out.jsonl"))[0] == 0 and len((tmp_path / "out.jsonl").read_text().splitlines()) == got["accepted_count"]
    assert not list(tmp_path.rglob("pending-*"))
    with pytest.raises(ValueError):
        E.freeze_table(spark, store, spark.createDataFrame([("a", None)], "record_id string, source_record_id string"), "bad", "exact_recall")
    (tmp_path / "s" / store.key(told["record_shards"][0]["uri"])).write_text("{}\n")
    with pytest.raises(StoreConflict):
        E.verify_set(store, told["uri"], spark=spark)


def test_two_stores_get_the_same_bytes(spark, tmp_path):
    rows = spark.range(25).selectExpr("24 - id as ordinal", "concat('r', id) as record_id", "named_struct('b', id, 'a', null) as metadata")
    shards = [ArtifactStore(str(tmp_path / name)).publish_rows(df, "records", shard_rows=10) for name, df in (("x", rows), ("y", rows.repartition(7)))]
    assert shards[0] == shards[1] and [s["row_count"] for s in shards[0]] == [10, 10, 5]
    got = ArtifactStore(str(tmp_path / "x")).shard_rows(shards[0])
    assert [r["ordinal"] for r in got] == list(range(25)) and (tmp_path / "x/records/000000.jsonl").read_text().startswith('{"metadata": {"a": null, "b": 24}, "ordinal": 0')
    assert ArtifactStore(str(tmp_path)).publish_rows(rows.limit(0), "none") == []


def test_config_export_reads_back():
    config = C.parse('context_limit_tokens = 5\n[models.generator]\nmodel = "m \\"x\\""\n[models.student]\nmodel = "s"\nmax_output_tokens = 3\n[probing]\nknown_sample_rate = 0.5\n[data]\nclassification = "internal"\n')
    again = C.parse(C.export(config))
    assert again.identity() == config.identity() and again.policy == config.policy and config.role("student").max_output_tokens == 3 and config.role("validator").model == 'm "x"'
