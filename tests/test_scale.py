"""What must not grow faster than the input: tasks and writes of calls, copies of passages, copies of a seed's relations."""

import pytest
from pyspark.sql import functions as F

from passagemill.operators import handoffs as N
from passagemill.operators import knowledge as K
from passagemill.operators.clients import Role
from passagemill.plans import build as B
from passagemill.operators import records as R
from passagemill.plans import catalog, recipes
from passagemill.plans import config as C
from passagemill.plans.catalog_sources import supplier_bundle, supplier_sets
from passagemill.functions.hashing import deterministic_id
from passagemill.sources import evidence as V
from passagemill.sources.store import ArtifactStore

from .test_build import TOML, evidence
from .test_catalog import TABLES


def test_calls_have_so_many_tasks_a_core_and_their_log_is_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(B, "TASKS_A_CORE", 1)
    written, write = [], ArtifactStore._write_observed
    monkeypatch.setattr(ArtifactStore, "_write_observed", lambda self, df, key, *a, **k: (written.append(key), write(self, df, key, *a, **k))[1])
    got = B.build(spark, ArtifactStore(str(tmp_path)), evidence(spark, 40), "paragraph-qa-qualified", C.parse("answers_per_task = 1\n" + TOML), "demo", "s")
    for stage in ("generation", "qualification-requirements", "qualification-answerability", "qualification-reference"):
        (table,) = (p for p in tmp_path.rglob(f"stages/{stage}/table"))
        assert 0 < len(list(table.glob("part-*"))) <= spark.sparkContext.defaultParallelism
        assert f"answers/{stage}" in written and f"stages/{stage}/table" not in written
    assert got["call_count"] > 100 and not list(tmp_path.rglob("answers/*"))


def test_units_are_written_without_the_passages_they_cite(spark, tmp_path):
    B.build(spark, ArtifactStore(str(tmp_path)), evidence(spark), "knowledge-unit-qa", C.parse(TOML), "demo", "s")
    (table,) = tmp_path.rglob("stages/knowledge-units/table")
    columns = spark.read.parquet(str(table)).columns
    assert "evidence_ids" in columns and "cited" not in columns


def test_cited_texts_come_to_the_rows(spark):
    texts = spark.createDataFrame([(f"e{k}", f"d{k}", f"a{k}", f"text {k}") for k in range(4)], "evidence_id string, document_id string, source_asset_id string, text string")
    lists = [["e0"], ["e1", "e0"], ["e0", "e1", "e0"], ["e9"], [], ["e9", "e2"], ["e3"]]
    rows = spark.createDataFrame([(f"u{k}-{n}", "e0", k * 40 + n, ids) for k, ids in enumerate(lists) for n in range(40)], "unit_row string, evidence_id string, pos int, evidence_ids array<string>")
    want = {r.unit_row: r.cited for r in K.cite(rows, texts).collect()}
    got = K.with_cited(rows, texts, "unit_row", 5, 7).select("unit_row", "cited").collect()
    assert len(got) == len(want) == 280 and {r.unit_row: r.cited for r in got} == want and want["u2-0"] == "text 0\ntext 1\ntext 0"


@pytest.mark.skipif(not TABLES.exists(), reason="the driver's tables are not here")
def test_relations_are_hashed_once_a_seed(spark):
    plan = catalog.QUERIES["composite_handoffs"](spark, str(TABLES))._jdf.queryExecution().optimizedPlan().toString()
    assert "excluded_relations" not in plan and "sha2" not in plan.split("Join")[0].replace("sha2(, 256)", "")
    got = N.composites(supplier_bundle(spark, str(TABLES)), supplier_sets(spark, str(TABLES)), Role("claim"), catalog.RuleResponder)
    seeds = got.by_seed.count()
    assert 0 < seeds <= 6 < got.bare.count() == got.records.count()


def test_dedup_carries_nothing_that_can_be_made_after_it(spark):
    rows = evidence(spark, 3)
    probes = recipes.probe_skeleton(recipes.knowledge_units(rows), 2)
    plan = recipes.probed_qa(probes, "demo")._jdf.queryExecution().optimizedPlan().toString()
    carried = next(line for line in plan.splitlines() if "Aggregate" in line).partition("AS _first")[0]
    assert "answer" in carried and not any(c in carried for c in ("record_id", "question,", "source_asset_ids", "evidence_ids"))


def test_first_of_equal_fingerprints_by_order_whatever_the_columns(spark):
    rows = spark.createDataFrame([("f", 2, "a", [1]), ("f", 1, "z", [9]), ("g", 3, "b", [2])], "fp string, at int, x string, xs array<int>")
    want = {("f", 1, "z", (9,)), ("g", 3, "b", (2,))}
    mapped = rows.withColumn("m", F.create_map(F.lit("k"), F.col("x")))
    assert {(r.fp, r.at, r.x, tuple(r.xs)) for r in R.first_wins(rows, "fp", ["at"]).collect()} == want
    assert {(r.fp, r.at, r.x, tuple(r.xs)) for r in R.first_wins(mapped, "fp", ["at"]).collect()} == want
    assert R.first_wins(mapped, "fp", ["at"]).columns == mapped.columns


def test_validation_joins_no_texts(spark):
    plan = V.violations(evidence(spark), documents=evidence(spark).select("document_id"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "text#" not in plan.split("Join")[0]


def test_paragraph_records_leave_their_messages_where_they_were_written(spark, tmp_path):
    got = B.build(spark, ArtifactStore(str(tmp_path)), evidence(spark, 40), "paragraph-qa", C.parse(TOML), "demo", "s")
    (table,) = tmp_path.rglob("stages/records/table")
    kept = spark.read.parquet(str(table))
    assert not {"question", "answer", "source_text"} & set(kept.columns) and kept.count() == got["accepted_count"] > 0
    (told,) = tmp_path.rglob("stages/generation/table")
    assert not {"source_asset_ids", "document_ids", "source_text"} & set(spark.read.parquet(str(told)).columns)


def test_paragraph_records_are_those_of_joins_and_whole_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(B, "SHARD_ROWS", 3)
    kind = "evidence_id string, document_id string, source_asset_id string, text string, source_sha256 string, anchor_id string, block_id string, sequence_number long, page_number int, char_start int"
    lines = ["Same everywhere.", "Of two.", "Of two.", "Alone {k}."]
    rows = spark.createDataFrame([(f"e{k}", f"d{k % 3}", f"a{k % 2}" if k % 5 else None, "\n\n".join(lines).format(k=k), f"h{k}" if k % 4 else None, ("", "x", None)[k % 3], "x" if k % 2 else "y", k, 0, 0) for k in range(11)], kind)
    got = B.build(spark, ArtifactStore(str(tmp_path)), rows, "paragraph-qa", C.parse(TOML), "demo", "s", factory=catalog.RuleResponder)
    identity = deterministic_id("demo", "paragraph-qa", *map(F.col, ("evidence_id", "char_start", "char_end", "question", "answer")))
    made = recipes.records(recipes.template_answers(recipes.candidates(rows)), identity, ["document_id", "char_start", "evidence_id"])
    want = sorted(K.with_sources(made, rows).collect(), key=lambda r: (r.document_id, r.char_start, r.record_id))
    shown = ArtifactStore(str(tmp_path)).shard_rows(got["record_shards"])
    assert [(r["record_id"], r["messages"][1]["content"], r["ordinal"]) for r in shown] == [(r.record_id, r.answer, n) for n, r in enumerate(want)] and len(want) == 13
    for name in ("source_asset_ids", "document_ids", "evidence_ids", "source_anchor_ids", "split_group_id", "research_role", "training_eligible", "original_split"):
        assert [r["metadata"][name] for r in shown] == [r[name] for r in want]
    assert [x["row_count"] for x in got["record_shards"]] == [3, 3, 3, 3, 1]
    told = lambda df: [(r.source_hashes, r.source_anchor_ids) for r in df.orderBy(F.length("row"), "row").collect()]
    assert told(K.own_sources(rows.withColumn("row", F.col("evidence_id")))) == told(K.with_sources(rows.select(F.col("evidence_id").alias("row"), F.array("evidence_id").alias("evidence_ids")), rows, "row"))


@pytest.mark.parametrize("size", [0, 1, 7, 8, 100])
def test_rows_come_to_their_shards_in_one_shuffle(spark, size):
    data = [((None, "a", "b")[n % 3], n % 4, f"{n * 7919 % 1009:032x}", f"text {n}") for n in range(size)]
    rows = spark.createDataFrame(data, "document_id string, char_start int, record_id string, text string")
    kept = rows.where("record_id not like '%0'").drop("text")
    got = R.in_shards(rows, kept, ["document_id", "char_start", "record_id"], 7)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1 or not size
    found = got.withColumn("task", F.spark_partition_id()).collect()
    order = sorted((d for d in data if d[2][-1] != "0"), key=lambda d: (d[0] is not None, d[0] or "", d[1], d[2]))
    assert sorted((r.ordinal, r.shard, r.document_id, r.char_start, r.record_id, r.text) for r in found) == [(n, n // 7, *d) for n, d in enumerate(order)]
    assert len({(r.shard, r.task) for r in found}) == len({r.shard for r in found}) == -(-len(order) // 7)
