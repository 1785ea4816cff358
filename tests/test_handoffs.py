"""Handoffs in batches against one at a time, closures of many seeds, and copy fields."""

import json
import random
import uuid
from dataclasses import asdict

import pytest
from pyspark.sql import functions as F

from passagemill.operators import graph as G
from passagemill.operators import handoff as H
from passagemill.operators import handoffs as N
from passagemill.operators.clients import Role

from .test_build import bundle


class Says:
    """The same answers, for one at a time and as a responder."""

    generate = staticmethod(lambda text: (f"What is {text}?", text[:9].strip()))
    claim = staticmethod(lambda text: f"claim: {text}")

    def respond(self, role, messages):
        text = messages[-1]["content"]
        if "broken" in text:
            raise ValueError("no answer")
        return self.claim(text) if role == "claim" else json.dumps(dict(zip(("instruction", "answer"), self.generate(text))))


SETS = "evidence_set_id string, seed_id string, claim_ids array<string>, member_ids array<string>"


def plain_closure(edges, seed):
    reached, todo = {seed}, [seed]
    while todo:
        at = todo.pop()
        for s, t, ok in edges:
            if s == at and ok and t is not None and t not in reached:
                reached.add(t)
                todo.append(t)
    return reached


def test_closures_of_many_seeds(spark):
    rng = random.Random(5)
    names = [f"v{i}" for i in range(150)]
    edges = [(rng.choice(names), rng.choice([*names, None]), rng.random() < 0.8) for _ in range(260)]
    edges += [("hub", n, True) for n in names[:80]] + [(f"c{i}", f"c{i + 1}", True) for i in range(25)] + [("c25", "c0", True)]
    relations = spark.createDataFrame([(i, f"r{i}", *e) for i, e in enumerate(edges)], "pos int, relation_id string, source_id string, target_id string, gold_eligible boolean")
    seeds = [*names, "hub", "c3", "nowhere"]
    got = G.closures(relations, spark.createDataFrame([(s,) for s in [*seeds, "hub", None]], "vertex string"))
    want = {(s, v) for s in seeds for v in plain_closure(edges, s)}
    rows = [tuple(r) for r in got.rows().collect()]
    assert len(rows) == len(want) and set(rows) == want
    one = {(r.vertex,) for r in G.closure(relations, spark.createDataFrame([("hub",)], "vertex string")).collect()}
    assert one == {(v,) for s, v in want if s == "hub"}
    pairs = [(rng.choice([*seeds, "unknown"]), rng.choice([*names, "c9", "gone"]), i) for i in range(400)]
    lost = got.missing(spark.createDataFrame(pairs, "seed string, vertex string, n int"))
    assert sorted(map(tuple, lost.collect())) == sorted(p for p in pairs if p[:2] not in want)
    split = {(r.seed, r.relation_id, r.allowed) for r in got.partition(relations).collect()}
    assert split == {(s, f"r{i}", ok and t is not None) for s, v in want for i, (a, t, ok) in enumerate(edges) if a == v}


def records(handed):
    return {r.evidence_set_id: r for r in handed.records.collect()}


def test_batches_equal_one_at_a_time(spark):
    b = bundle(spark)
    sets = [("s1", "s1", ["c1"], ["A1"]), ("s2", "s1", ["c1", "c2", "c0"], ["A2", "A1", "A4"]), ("s3", "s3", ["c1"], ["A3"])]
    refused = [("far", "s1", ["c1"], ["A3"]), ("old", "s1", ["c1", "c2"], ["A1", "A5"]), ("gone", "s1", ["c1"], ["A9"]), ("few", "s1", ["c1"], ["A1", "A2"]), ("same", "s1", ["c", "c"], ["A1", "A2"]), ("none", "s1", [], []), ("null", "s1", None, ["A1"]), ("two", "s1", ["c"], ["A1"]), ("two", "s1", ["c"], ["A1"])]
    got = N.composites(b, spark.createDataFrame(sets + refused, SETS), Role("claim"), Says)
    made = records(got)
    assert set(made) == {"s1", "s2", "s3"}
    for name, seed, claim_ids, member_ids in sets:
        one = asdict(H.build_composite(b, seed, name, claim_ids, member_ids, Says()))
        many = made[name].asDict(recursive=True)
        assert json.loads(json.dumps(many)) == json.loads(json.dumps(one))
    assert {(r.evidence_set_id, r.problem, r.id) for r in got.refused.collect()} == {("far", "not_reached", "n3"), ("old", "obsolete", "A5"), ("gone", "no_exact_address", "A9"), ("few", "claims_and_members_differ", "few"), ("same", "claims_not_distinct", "same"), ("none", "claims_not_distinct", "none"), ("null", "claims_and_members_differ", "null"), ("two", "set_repeated", "two"), ("few", "no_exact_address", None), ("null", "claims_not_distinct", "null")} - {("few", "no_exact_address", None), ("null", "claims_not_distinct", "null")}
    with pytest.raises((H.HandoffError, H.SupportError)):
        got.require()
    assert N.composites(b, spark.createDataFrame(sets, SETS), Role("claim"), Says).require().count() == 3
    assert N.composites(b, spark.createDataFrame([], SETS), Role("claim"), Says).require().count() == 0


def test_failed_claims_are_refused(spark):
    b = bundle(spark, nodes=[("n1", "R", "s1", "Rule text."), ("n2", "R", "s2", "broken"), ("n3", "R", "s3", "x")])
    got = N.composites(b, spark.createDataFrame([("s1", "s1", ["c1", "c2"], ["A1", "A2"]), ("s2", "s1", ["c1"], ["A1"])], SETS), Role("claim"), Says)
    assert set(records(got)) == {"s2"} and [tuple(r) for r in got.refused.collect()] == [("s1", "claim_failed", "c2")]
    assert got.calls.where("call.status = 'failed'").count() == 1


SPAN = "view_id string, segment_id string, pos int, node_id string, char_start int, char_end int"


def test_paragraphs_in_a_batch(spark):
    b = bundle(spark)
    spans = [("v", "x", 0, "n1", None, None), ("v", "y", 0, "n2", None, None), ("v", "y", 1, "n1", 0, 4), ("v", "y", 2, "n2", None, None), ("v", "z", 0, "n1", 1, 4), ("w", "x", 0, "n3", None, None)]
    got = N.paragraphs(b, spark.createDataFrame(spans, SPAN), Role("generator"), Says)
    made = {(r.view_id, r.segment_id): r for r in got.records.collect()}
    assert set(made) == {("v", "x"), ("v", "y"), ("w", "x")}
    for (view, segment), row in made.items():
        mine = spark.createDataFrame([s[2:] for s in spans if s[:2] == (view, segment)], "pos int, node_id string, char_start int, char_end int")
        one = asdict(H.build_paragraph(b, view, segment, mine, Says()))
        assert row.asDict(recursive=True) == json.loads(json.dumps(one))
    assert [tuple(r) for r in got.refused.collect()] == [("v", "z", "no_exact_address", "n1")]
    twice = N.paragraphs(b, spark.createDataFrame([spans[0], spans[0]], SPAN), Role("generator"), Says)
    assert twice.records.count() == 0 and {r.problem for r in twice.refused.collect()} == {"segment_repeated"}


def jobs(spark, work):
    """Jobs that some work takes."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_jobs_don_t_grow_with_the_sets(spark):
    b = bundle(spark)

    def run(n):
        sets = spark.range(n).selectExpr("concat('set', id) AS evidence_set_id", "'s1' AS seed_id", "array('c1', 'c2') AS claim_ids", "array('A1', 'A2') AS member_ids")
        got = N.composites(b, sets, Role("claim"), Says)
        assert got.require().count() == n

    few, many = jobs(spark, lambda: run(10)), jobs(spark, lambda: run(10_000))
    assert many <= few * 1.3 + 5, (few, many)  # adaptive plans split a stage's jobs a little otherwise


# Fields that would carry copied text

FORBIDDEN = ("source_text", "paragraph_text", "evidence_text", "excerpt", "quoted_source", "context_text", "canonical_text_copy")


@pytest.mark.parametrize("name", FORBIDDEN)
def test_copies_are_refused_wherever_they_are(spark, name):
    for value in ({name: 1}, {"a": {name: None}}, {"a": [1, [{"b": ({name: "x"},)}]]}):
        with pytest.raises(H.HandoffError):
            H.refuse_copies(value)
    H.refuse_copies({"text": name, "content": [name], "passage": {"claims": name}})
    nested = spark.createDataFrame([], f"a struct<b:array<struct<{name}:string>>>, m map<string,struct<{name}:int>>, ok string").schema
    assert H.copy_columns(nested) == [f"a.b.{name}".replace("b.", "b."), f"m.{name}"]


def test_records_refuse_copies(spark, tmp_path):
    claim = H.Claim("c", "text", "A")
    with pytest.raises(H.HandoffError, match="excerpt"):
        H.CompositeHandoff("s", "e", (claim,), (), (), safety={"excerpt": False}).validate()
    H.CompositeHandoff("s", "e", (claim,), (), ()).validate()
    rows = spark.createDataFrame([(1, '{"a":[[{"excerpt":1}]],"b":{"c":{"source_text":{"excerpt":2}}}}'), (2, '{"text":"excerpt"}'), (3, "[]"), (4, "7"), (5, None)], "id int, j string")
    got = H.copies_within(rows.select("id", F.try_parse_json("j").alias("v")), "id", "v")
    assert sorted(map(tuple, got.collect())) == [(1, "excerpt"), (1, "source_text")]
