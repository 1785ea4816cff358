import json
import re

import pytest
from pyspark.sql import functions as F

from passagemill.functions import hashing as H
from passagemill.functions import text as T
from passagemill.operators import knowledge as K
from passagemill.operators import qualification as Q
from passagemill.operators import records as R
from passagemill.sources import evidence as V

TEXTS = ["", " ", "a", "a\n\nb", "\n\n a \n \t\n\n b\n", "é😀\n\n\n\nz", "x\n", "\n \n"]


def paragraphs(text):
    at, out = 0, []
    for piece, gap in zip([*re.split(r"\n[ \t]*\n", text)], [*re.findall(r"\n[ \t]*\n", text), ""]):
        if piece.strip():
            out.append((at, at + len(piece), piece))
        at += len(piece) + len(gap)
    return out


def test_paragraph_spans(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string").select("text", T.paragraph_spans(F.col("text")).alias("s"))
    for r in df.collect():
        assert [tuple(x) for x in r.s] == paragraphs(r.text), repr(r.text)


def test_ids_agree_with_the_driver(spark):
    df = spark.createDataFrame([("a", 1, None)], "x string, y int, z string").select(H.deterministic_id(F.col("x"), F.col("y"), F.col("z"), "q").alias("id"))
    assert df.first().id == H.make_id("a", 1, "", "q")


def test_numeric_roles(spark):
    rows = [
        ("the ratio is 2 items", "2", ["ratio"], "item", True),
        ("the ratio is two items", "2", ["ratio"], "items", True),
        ("the ratio of all of these is 2 items", "2", ["ratio"], "item", False),
        ("the delay is 2 and then the ratio is 3", "2", ["ratio"], "", False),
        ("2.", "2", [], "", True),
        ("ratio 2", "2", ["ratio"], "None", False),
        ("", "2", [], "", False),
        ("costs 2,750 now", "2,750", [], "", False),
    ]
    df = spark.createDataFrame(rows, "ref string, value string, terms array<string>, unit string, want boolean")
    got = df.select("ref", "want", T.numeric_role_present(F.col("ref"), F.col("value"), F.col("terms"), F.col("unit")).alias("got"))
    assert all(r.got == r.want for r in got.collect()), got.collect()


def decide(spark, requirements, answerability, qualification, reference, resolvable=True):
    kinds = f"requirements {Q.REQUIREMENTS}, answerability {Q.ANSWERABILITY}, qualification {Q.QUALIFICATION}, reference string, provenance_resolvable boolean"
    parse = lambda f, x: None if x is None else f(json.dumps(x))
    row = (parse(Q.parse_requirements, requirements), parse(Q.parse_answerability, answerability), parse(Q.parse_qualification, qualification), reference, resolvable)
    return Q.decide(spark.createDataFrame([row], kinds)).first()


REQ = {"required_slots": ["limit"], "answer_structure": "text", "requirements": [{"requirement_id": "limit", "semantic_role": "wait limit", "value_type": "number", "unit": "days"}]}
ANS = {"answerable_at_requested_specificity": True, "slot_values": {"limit": {"value": 4, "unit": "days"}}}
QUAL = {"answers_question": True, "required_slot_coverage": 1.0}


@pytest.mark.parametrize(
    "change,reference,decision,codes",
    [
        ({}, "wait four days", "accepted", []),
        ({}, "wait five days, pay 4 euros now or later", "rejected", ["numeric_role_binding_failed"]),
        ({"q": {"unsupported_claims": ["x"], "premise_restatement": True}}, "wait 4 days", "rejected", ["premise_restatement", "unsupported_claim"]),
        ({"q": {"answers_question": False, "required_slot_coverage": 0.5}}, "wait 4 days", "rejected", ["reference_does_not_answer_question", "missing_required_facts"]),
        ({"r": {"question_validity": "uncertain"}, "q": {"contradicted_claims": ["c"]}}, "wait 4 days", "needs_review", ["question_validity_uncertain", "contradicted_claim"]),
        ({"a": {"answerable_at_requested_specificity": False}}, "wait 4 days", "rejected", ["source_not_answerable_at_requested_specificity"]),
        ({"a": {"slot_values": {"limit": ["red", "blue"]}}}, "red", "rejected", ["missing_required_members"]),
        ({"q": {"source_faithfulness": "failed"}}, "wait 4 days", "rejected", ["source_faithfulness_failed"]),
        ({"q": {"requirement_results": [{"requirement_id": "limit", "relation_matches": False, "qualifiers_present": False}]}}, "wait 4 days", "rejected", ["numeric_role_binding_failed", "missing_mandatory_qualifier"]),
    ],
)
def test_decisions(spark, change, reference, decision, codes):
    got = decide(spark, REQ | change.get("r", {}), ANS | change.get("a", {}), QUAL | change.get("q", {}), reference)
    assert (got.decision, got.reason_codes) == (decision, codes)
    assert got.rewrite_allowed is False


def test_missing_stage_needs_review(spark):
    got = decide(spark, None, ANS, QUAL, "x")
    assert (got.decision, got.reason_codes, got.quality_label) == ("needs_review", ["qualification_infrastructure_uncertainty"], "not_determined")
    assert decide(spark, REQ, ANS, QUAL, "wait 4 days", False).reason_codes == ["provenance_unresolvable"]


@pytest.mark.parametrize(
    "parse,raw",
    [
        (Q.parse_requirements, '{"required_slots": []}'),
        (Q.parse_requirements, '{"required_slots": [], "answer_structure": "t", "question_validity": "maybe"}'),
        (Q.parse_requirements, '{"required_slots": [], "answer_structure": "t", "requirements": [{"requirement_id": "a"}, {"requirement_id": "a"}]}'),
        (Q.parse_answerability, '{"answerable_at_requested_specificity": "true"}'),
        (Q.parse_answerability, '{"answerable_at_requested_specificity": true, "x": [{"source_text": "s"}]}'),
        (Q.parse_qualification, '{"answers_question": true, "required_slot_coverage": true}'),
        (Q.parse_qualification, '{"answers_question": true, "required_slot_coverage": 1.5}'),
        (Q.parse_qualification, "[]"),
        (Q.parse_qualification, '{"answers_question": true} x'),
    ],
)
def test_bad_stage_outputs(parse, raw):
    with pytest.raises(ValueError):
        parse(raw)


def test_stages_are_blind(spark):
    df = spark.createDataFrame([("c", "q", "s", "ref", "r", "a")], "candidate_id string, question string, source_text string, reference string, requirements string, answerability string")
    assert Q.blind(df, "requirements").columns == ["candidate_id", "question"]
    assert "reference" not in Q.blind(df, "answerability").columns and "source_text" not in Q.blind(df, "reference").columns


def test_first_wins_and_ordinals(spark):
    df = spark.createDataFrame([(i, f"k{i % 3}") for i in range(50)], "n long, k string").repartition(5)
    assert sorted((r.k, r.n) for r in R.first_wins(df, "k", ["n"]).collect()) == [("k0", 0), ("k1", 1), ("k2", 2)]
    got = {r.n: r.ordinal for r in R.row_numbers(df, F.desc("n")).collect()}
    assert got == {i: 49 - i for i in range(50)}


def row(i, **more):
    return {"evidence_id": f"e{i}", "document_id": "d1", "source_asset_id": "a1", "run_id": "r", "context_id": "c", "page_number": 1, "text": "some text", "char_start": 0, "char_end": 9, "source_sha256": "s", **more}


@pytest.mark.parametrize(
    "bad,rule",
    [({"run_id": "x"}, "run_mismatch"), ({"context_id": "x"}, "context_mismatch"), ({"document_id": "x"}, "unknown_document"), ({"source_asset_id": "x"}, "unknown_asset"), ({"source_sha256": "x"}, "source_hash_mismatch"), ({"evidence_id": "e0"}, "duplicate_evidence_id"), ({"text": " \n"}, "blank_text")],
)
def test_evidence_rules(spark, tmp_path, bad, rule):
    (tmp_path / "e.jsonl").write_text("".join(json.dumps(x) + "\n\n" for x in (row(0), row(1, **bad))))
    df = V.scan(spark, str(tmp_path / "e.jsonl"))
    context = {"run_id": "r", "context_id": "c", "documents": spark.createDataFrame([("d1",)], "document_id string"), "assets": spark.createDataFrame([("a1", "s")], "asset_id string, sha256 string")}
    with pytest.raises(V.EvidenceError, match=rule):
        V.validate(df, **context)


def test_evidence_scan_fails_closed(spark, tmp_path):
    (tmp_path / "e.jsonl").write_text(json.dumps(row(0)) + "\nnot json\n")
    with pytest.raises(V.EvidenceError, match="not json"):
        V.scan(spark, str(tmp_path / "e.jsonl"))
    assert V.optional_jsonl(spark, str(tmp_path / "none.jsonl"), "a string").count() == 0


def test_unit_parsing():
    assert [u["canonical_statement"] for u in K.parse_units('{"knowledge_units": [{"canonical_statement": " a "}]}', "e")] == ["a"]
    for raw in ('{"x": 1}', '[{"canonical_statement": ""}]', '[{"canonical_statement": "a", "source_evidence_ids": ["other"]}]', "nope"):
        with pytest.raises(ValueError):
            K.parse_units(raw, "e")


def test_ordinals_of_many_rows(spark):
    n = 200_000
    rows = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), (F.col("id") % 3).alias("g")).repartition(8)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    got = R.row_numbers(rows, F.col("k"))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got.columns == ["k", "g", "ordinal"]
    assert got.agg(F.count_distinct("ordinal"), F.min("ordinal"), F.max("ordinal"), F.count_if(F.col("k") != F.col("ordinal"))).first() == (n, 0, n - 1, 0)
