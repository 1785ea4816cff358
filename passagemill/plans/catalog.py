"""Named queries over the driver's tables, and the SQL that gives the same rows.

The tables are read as the engine's domain: documents are evidence (line breaks doubled, so that paragraphs exist),
neighbouring user and assistant turns are question and answer pairs, labels judge probes, regions, nations and
suppliers are a source graph, and events are a job log.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..functions import text as T
from ..operators import evalsets as E
from ..operators import graph as G
from ..operators import handoff as H2
from ..operators import knowledge as K
from ..operators import qualification as Q
from ..operators import records as R
from ..operators import responder as M
from ..sources import evidence as V
from ..sources import manifest as S
from ..sources import scratch
from ..sources.store import IDENTIFIER, ArtifactStore
from . import build as B
from . import config as C
from . import recipes

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
DATASET = "demo"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# Views, on both sides


def evidence(spark, d: str) -> DataFrame:
    n = F.col("doc_id")
    return read(spark, d, "documents").select(
        F.concat(F.lit("ev-"), n).alias("evidence_id"), F.concat(F.lit("doc-"), n).alias("document_id"), F.col("source").alias("source_asset_id"),
        F.regexp_replace("text", "\n", "\n\n").alias("text"), F.when(n % 7 != 0, n % 11).alias("sequence_number"), (n % 5).alias("page_number"), F.lit(0).alias("char_start"), "lang", n.alias("n"),
    )


EV = """ev AS (SELECT 'ev-' || doc_id AS evidence_id, 'doc-' || doc_id AS document_id, source AS source_asset_id, replace(text, chr(10), chr(10) || chr(10)) AS text,
  CASE WHEN doc_id % 7 <> 0 THEN doc_id % 11 END AS sequence_number, doc_id % 5 AS page_number, 0 AS char_start, lang, doc_id AS n FROM documents)"""
SPANS = EV + r""", p AS (SELECT *, string_split_regex(text, '\n[ \t]*\n') AS pieces, regexp_extract_all(text, '\n[ \t]*\n') AS gaps FROM ev),
  i AS (SELECT * EXCLUDE (char_start), unnest(range(1, len(pieces) + 1)) AS i FROM p),
  t AS (SELECT *, pieces[i] AS chunk, (coalesce(list_sum(list_transform(pieces[1:i-1], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(gaps[1:i-1], lambda x: length(x))), 0))::INT AS char_start FROM i),
  spans AS (SELECT evidence_id, document_id, source_asset_id, char_start, (char_start + length(chunk))::INT AS char_end, chunk FROM t WHERE regexp_matches(chunk, '\S'))"""
ID = lambda *x: "substr(sha256(concat_ws(chr(31), " + ", ".join(f"({y})::VARCHAR" for y in x) + ")), 1, 32)"
STRIP = lambda x: rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"
PRINT = "sha256('[{\"content\":' || to_json(question)::VARCHAR || ',\"role\":\"user\"},{\"content\":' || to_json(answer)::VARCHAR || ',\"role\":\"assistant\"}]')"
NUMBER = lambda x: f"('0x' || substr({x}, 1, 8))::BIGINT"
SPLIT = lambda g: (
    f"CASE WHEN {NUMBER(f'sha256(concat_ws(chr(31), {chr(39)}{H.SPLIT_SEED}{chr(39)}, {g}))')} % 100 < 80 THEN 'train' WHEN {NUMBER(f'sha256(concat_ws(chr(31), {chr(39)}{H.SPLIT_SEED}{chr(39)}, {g}))')} % 100 < 90 THEN 'validation' ELSE 'test' END"
)
CAND = SPANS + f", cand AS (SELECT *, {ID('evidence_id', 'char_start', 'char_end')} AS candidate_id, '{recipes.ASK}' AS question, {STRIP('chunk')} AS answer FROM spans)"


def finish(source: str, identity: str, order: str) -> str:
    """Records of a relation with question, answer and source_asset_id."""
    return f""", made AS (SELECT *, {identity} AS record_id, {PRINT} AS fingerprint FROM {source}),
  firsts AS (SELECT * FROM made QUALIFY row_number() OVER (PARTITION BY fingerprint ORDER BY {order}) = 1),
  final AS (SELECT *, 'source_asset_ids:' || source_asset_id AS split_group_id, {SPLIT("'source_asset_ids:' || source_asset_id")} AS split FROM firsts)"""


SHOWN = ["record_id", "question", "answer", "split_group_id", "split", "research_role", "training_eligible"]
SHOW = "SELECT record_id, question, answer, split_group_id, split, CASE WHEN split = 'train' THEN 'training' ELSE 'legacy_' || split END AS research_role, split = 'train' AS training_eligible FROM final"


def pairs(spark, d: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    turns = read(spark, d, "conversations").withColumns({"next_role": F.lead("role").over(w), "next_text": F.lead("text").over(w)})
    return turns.where("role = 'user' and next_role = 'assistant'").select("conv_id", "turn", F.col("text").alias("question"), F.col("next_text").alias("answer"))


QA = """w AS (SELECT *, lead(role) OVER x AS next_role, lead(text) OVER x AS next_text FROM conversations WINDOW x AS (PARTITION BY conv_id ORDER BY turn)),
  qa AS (SELECT conv_id, turn, text AS question, next_text AS answer FROM w WHERE role = 'user' AND next_role = 'assistant')"""


def judged(spark, d: str) -> DataFrame:
    kind = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "known").when((F.col("quality") == 1) & (F.col("toxic") == 1), "partial").when(F.col("toxic") == 0, "unknown").otherwise("invalid_probe")
    return read(spark, d, "labels").select("doc_id", H.deterministic_id("judgment", F.col("doc_id")).alias("probe_id"), kind.alias("probe_class"))


JUDGED = f"judged AS (SELECT doc_id, {ID(chr(39) + 'judgment' + chr(39), 'doc_id')} AS probe_id, CASE WHEN quality = 1 AND toxic = 0 THEN 'known' WHEN quality = 1 THEN 'partial' WHEN toxic = 0 THEN 'unknown' ELSE 'invalid_probe' END AS probe_class FROM labels)"


def relations(spark, d: str) -> DataFrame:
    name = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string"))
    nation, supplier = read(spark, d, "nation"), read(spark, d, "supplier")
    down = nation.select(name("r", "n_regionkey").alias("source_id"), name("n", "n_nationkey").alias("target_id"), F.lit(True).alias("gold_eligible"))
    out = supplier.select(name("n", "s_nationkey").alias("source_id"), name("s", "s_suppkey").alias("target_id"), (F.col("s_acctbal") >= 0).alias("gold_eligible"))
    back = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(name("s", "s_suppkey").alias("source_id"), name("r", "n_regionkey").alias("target_id"), F.lit(True).alias("gold_eligible"))
    open_end = supplier.select(name("s", "s_suppkey").alias("source_id"), F.lit(None).cast("string").alias("target_id"), F.lit(True).alias("gold_eligible"))
    return down.unionByName(out).unionByName(back).unionByName(open_end)


GRAPH = """rel AS (SELECT 'r' || n_regionkey AS source_id, 'n' || n_nationkey AS target_id, true AS gold_eligible FROM nation
  UNION ALL SELECT 'n' || s_nationkey, 's' || s_suppkey, s_acctbal >= 0 FROM supplier
  UNION ALL SELECT 's' || s_suppkey, 'r' || n_regionkey, true FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT 's' || s_suppkey, NULL, true FROM supplier),
  reach AS (SELECT 'r1' AS vertex UNION SELECT target_id FROM reach JOIN rel ON source_id = vertex WHERE gold_eligible AND target_id IS NOT NULL)"""


def reached(spark, d: str) -> DataFrame:
    return G.closure(relations(spark, d), spark.createDataFrame([("r1",)], "vertex string"))


# Evidence


@query(f"WITH {SPANS} SELECT evidence_id, char_start, char_end, chunk FROM spans")
def paragraph_spans(spark, d):
    return recipes.spans(evidence(spark, d)).select("evidence_id", "char_start", "char_end", "chunk")


@query(f"WITH {CAND} SELECT candidate_id, evidence_id, char_start, char_end FROM cand")
def candidate_ids(spark, d):
    return recipes.candidates(evidence(spark, d)).select("candidate_id", "evidence_id", "char_start", "char_end")


@query(f"WITH {EV} SELECT evidence_id, row_number() OVER (ORDER BY document_id, sequence_number NULLS LAST, page_number, char_start, evidence_id) - 1 AS ordinal FROM ev")
def evidence_order(spark, d):
    return V.ordered(evidence(spark, d).select("evidence_id", "document_id", "sequence_number", "page_number", "char_start")).select("evidence_id", "ordinal")


@query(f"""WITH {EV}, e AS (SELECT *, CASE WHEN lang = 'es' THEN 'run-2' ELSE 'run-1' END AS run_id, md5(source_asset_id || CASE WHEN n % 13 = 0 THEN 'x' ELSE '' END) AS sha FROM ev)
SELECT evidence_id, 'run_mismatch' AS rule, 0 AS precedence FROM e WHERE run_id <> 'run-1' UNION ALL
SELECT evidence_id, 'unknown_document', 2 FROM e WHERE NOT EXISTS (SELECT 1 FROM e AS known WHERE known.lang <> 'de' AND known.document_id = e.document_id) UNION ALL
SELECT evidence_id, 'unknown_asset', 3 FROM e WHERE source_asset_id = 'src7' UNION ALL
SELECT evidence_id, 'source_hash_mismatch', 4 FROM e WHERE source_asset_id <> 'src7' AND sha <> md5(source_asset_id) UNION ALL
SELECT evidence_id, 'duplicate_evidence_id', 5 FROM e WHERE evidence_id IN (SELECT evidence_id FROM e GROUP BY 1 HAVING count(*) > 1) UNION ALL
SELECT evidence_id, 'blank_text', 6 FROM e WHERE text IS NULL OR NOT regexp_matches(text, '[^\\t-\\r\\x{{85}}\\pZ]')""")
def evidence_violations(spark, d):
    e = evidence(spark, d).withColumns({"run_id": F.when(F.col("lang") == "es", "run-2").otherwise("run-1"), "context_id": F.lit("c"), "source_sha256": F.md5(F.concat("source_asset_id", F.when(F.col("n") % 13 == 0, "x").otherwise("")))})
    assets = e.where("source_asset_id <> 'src7'").select(F.col("source_asset_id").alias("asset_id"), F.md5("source_asset_id").alias("sha256")).distinct()
    return V.violations(e, run_id="run-1", documents=e.where("lang <> 'de'"), assets=assets)


@query(f"WITH {EV} SELECT evidence_id, NOT regexp_matches(regexp_replace(text, '[A-Za-z]', '', 'g'), '\\S') AS blank FROM ev")
def blank_evidence(spark, d):
    return evidence(spark, d).select("evidence_id", (~T.has_text(F.regexp_replace("text", "[A-Za-z]", ""))).alias("blank"))


@query(f"WITH {EV} SELECT md5(text) AS evidence_id, count(*) AS n FROM ev GROUP BY 1 HAVING count(*) > 1")
def duplicate_evidence_ids(spark, d):
    return evidence(spark, d).groupBy(F.md5("text").alias("evidence_id")).agg(F.count("*").alias("n")).where("n > 1")


@query(f"WITH {EV} SELECT evidence_id, CASE WHEN lang = source_asset_id OR n % 3 = 0 THEN lang WHEN n % 4 = 0 THEN source_asset_id ELSE lang || '|' || source_asset_id END AS anchors FROM ev")
def source_anchors(spark, d):
    e = evidence(spark, d).withColumn("anchor_id", F.when((F.col("n") % 4 != 0) | (F.col("n") % 3 == 0), F.col("lang")).otherwise("")).withColumn("block_id", F.when(F.col("n") % 3 != 0, F.col("source_asset_id")).otherwise(F.col("lang")))
    return e.select("evidence_id", F.array_join(V.source_anchors(), "|").alias("anchors"))


# Identities, splits, records


@query(f"SELECT doc_id, {ID('doc_id', 'lang', 'source')} AS id FROM documents")
def deterministic_id(spark, d):
    return read(spark, d, "documents").select("doc_id", H.deterministic_id(F.col("doc_id"), F.col("lang"), F.col("source")).alias("id"))


@query(f"WITH {QA} SELECT conv_id, turn, {PRINT} AS fingerprint FROM qa")
def messages_fingerprint(spark, d):
    return pairs(spark, d).select("conv_id", "turn", H.message_fingerprint(F.col("question"), F.col("answer")).alias("fingerprint"))


@query(f"WITH g AS (SELECT doc_id, 'document_ids:' || doc_id AS g FROM documents) SELECT doc_id, {SPLIT('g')} AS split FROM g")
def split_for_group(spark, d):
    return read(spark, d, "documents").select("doc_id", H.split_for_group(F.concat(F.lit("document_ids:"), "doc_id")).alias("split"))


@query("SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'eval' ELSE 'train' END AS split FROM documents")
def split_for_index(spark, d):
    return read(spark, d, "documents").select("doc_id", H.split_for_index(F.col("doc_id")).alias("split"))


@query("SELECT doc_id, CASE WHEN doc_id % 5 > 0 THEN 'source_asset_ids:' || least(source, lang) WHEN doc_id % 3 > 0 THEN 'document_ids:' || doc_id WHEN doc_id % 2 > 0 THEN 'knowledge_unit:' || doc_id WHEN doc_id % 4 > 0 THEN 'evidence:' || lang ELSE 'ungrouped' END AS grp FROM documents")
def record_group(spark, d):
    n, none = F.col("doc_id"), F.array().cast("array<string>")
    group = R.record_group(
        F.when(n % 5 > 0, F.array("source", "lang")).otherwise(none), F.when(n % 3 > 0, F.array(n.cast("string"))).otherwise(none),
        F.when(n % 2 > 0, n.cast("string")).otherwise(""), F.when(n % 4 > 0, F.array("lang")).otherwise(none),
    )
    return read(spark, d, "documents").select("doc_id", group.alias("grp"))


P1_RECORDS = f"WITH {CAND}" + finish("cand", ID("'demo'", "'paragraph-qa'", "evidence_id", "char_start", "char_end", "question", "answer"), "document_id, char_start, evidence_id")


@query(f"{P1_RECORDS} {SHOW}")
def paragraph_qa_records(spark, d):
    return recipes.paragraph_qa(evidence(spark, d), DATASET).select(*SHOWN)


@query(f"WITH {EV} SELECT md5(text) AS fingerprint, min_by(evidence_id, n) AS first_id FROM ev GROUP BY 1")
def dedup_first_wins(spark, d):
    rows = evidence(spark, d).select(F.md5("text").alias("fingerprint"), "n", "evidence_id")
    return R.first_wins(rows, "fingerprint", ["n"]).select("fingerprint", F.col("evidence_id").alias("first_id"))


@query(f"{P1_RECORDS} SELECT count(*) FILTER (split = 'train') AS train_count, count(*) FILTER (split = 'validation') AS validation_count, count(*) FILTER (split = 'test') AS test_count, count(*) FILTER (split <> 'train') AS eval_count FROM final")
def split_counts(spark, d):
    return R.split_counts(recipes.paragraph_qa(evidence(spark, d), DATASET))


@query(f"WITH {CAND} SELECT count(*) - count(DISTINCT {PRINT}) AS duplicates FROM cand")
def duplicate_count(spark, d):
    prints = recipes.template_answers(recipes.candidates(evidence(spark, d))).select(H.message_fingerprint(F.col("question"), F.col("answer")).alias("f")).groupBy("f").count()
    return prints.agg((F.sum("count") - F.count("*")).alias("duplicates"))


@query(f"{P1_RECORDS} SELECT record_id, split, CASE WHEN split = 'train' THEN 'training' ELSE 'legacy_' || split END AS research_role, CASE WHEN split <> 'train' THEN split END AS original_split FROM final")
def research_role_stamp(spark, d):
    return recipes.paragraph_qa(evidence(spark, d), DATASET).select("record_id", "split", "research_role", "original_split")


@query(f"{P1_RECORDS} SELECT {ID('record_id', chr(39) + 'exact-recall' + chr(39), chr(39) + 'v1' + chr(39))} AS record_id, record_id AS source_record_id, 'evaluation' AS split, 'exact_recall' AS research_role, false AS training_eligible FROM final WHERE split = 'train'")
def exact_recall_copy(spark, d):
    return E.exact_recall(recipes.paragraph_qa(evidence(spark, d), DATASET), "v1").select("record_id", "source_record_id", "split", "research_role", "training_eligible")


# Units, probes, lineage


@query("SELECT source AS unit, array_to_string(list_sort(list(DISTINCT lang)), '|') AS assets, count(*) AS n FROM documents GROUP BY source")
def assets_per_unit(spark, d):
    return read(spark, d, "documents").groupBy(F.col("source").alias("unit")).agg(F.array_join(F.sort_array(F.collect_set("lang")), "|").alias("assets"), F.count("*").alias("n"))


@query("SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS cited FROM conversations GROUP BY conv_id")
def cited_text(spark, d):
    rows = R.keep_ordered(read(spark, d, "conversations"), ["conv_id"], "turn", "text", "texts")
    return rows.select("conv_id", F.array_join("texts", "\n").alias("cited"))


@query(f"WITH {JUDGED} SELECT d.doc_id, d.lang FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM judged WHERE probe_class IN ('known', 'partial'))")
def accepted_semi_join(spark, d):
    accepted = judged(spark, d).where("probe_class in ('known', 'partial')")
    return read(spark, d, "documents").select("doc_id", "lang").join(accepted, "doc_id", "left_semi")


@query(f"SELECT doc_id::VARCHAR AS knowledge_unit_id, i::INT AS question_index, {ID('doc_id', 'i', chr(39) + 'probe' + chr(39))} AS probe_id FROM documents, range(3) r(i)")
def probe_skeleton(spark, d):
    return recipes.probe_skeleton(read(spark, d, "documents").select(F.col("doc_id").cast("string").alias("knowledge_unit_id")), 3)


@query(f"WITH {JUDGED} SELECT * FROM judged WHERE probe_class IN ('unknown', 'partial') OR probe_class = 'known' AND {NUMBER('probe_id')} / 4294967295.0 < 0.25")
def probe_selection(spark, d):
    return recipes.selected_probes(judged(spark, d), known_rate=0.25)


@query(f"WITH {JUDGED} SELECT probe_class AS decision, count(*) AS n FROM judged GROUP BY 1")
def decision_counts(spark, d):
    return judged(spark, d).groupBy(F.col("probe_class").alias("decision")).agg(F.count("*").alias("n"))


UNITS = SPANS + rf", sentences AS (SELECT * EXCLUDE (chunk), unnest(string_split(chunk, '.')) AS sentence FROM spans), units AS (SELECT *, {STRIP('sentence')} AS canonical_statement FROM sentences), ku AS (SELECT *, {ID('evidence_id', 'canonical_statement')} AS knowledge_unit_id FROM units WHERE canonical_statement <> '')"
ACCEPT = f"{NUMBER('knowledge_unit_id')} % 10 > 0"
KU_QA = f"kuqa AS (SELECT *, '{recipes.ASK}' AS question, canonical_statement AS answer FROM ku WHERE {ACCEPT})"


@query(f"WITH {UNITS}, {KU_QA}" + finish("kuqa", ID("'demo'", "knowledge_unit_id", "question", "answer"), "document_id, char_start, knowledge_unit_id") + SHOW)
def knowledge_unit_records(spark, d):
    units = recipes.knowledge_units(evidence(spark, d))
    accepted = units.where(H.leading_number(F.col("knowledge_unit_id")) % 10 > 0).select("knowledge_unit_id")
    return recipes.knowledge_unit_qa(units, accepted, DATASET).select(*SHOWN)


PROBED = f"""pr AS (SELECT ku.*, i AS question_index, {ID('knowledge_unit_id', 'i', chr(39) + 'probe' + chr(39))} AS probe_id FROM ku, range(2) r(i)),
  sel AS (SELECT *, '{recipes.ASK}' AS question, canonical_statement || ' #' || question_index AS answer FROM pr WHERE {NUMBER('probe_id')} % 3 > 0)"""


@query(f"WITH {UNITS}, {PROBED}" + finish("sel", ID("'demo'", "probe_id", "question", "answer"), "document_id, char_start, probe_id") + SHOW)
def probed_records(spark, d):
    probes = recipes.probe_skeleton(recipes.knowledge_units(evidence(spark, d)), 2)
    bucket = H.leading_number(F.col("probe_id")) % 3
    classed = probes.withColumn("probe_class", F.when(bucket == 0, "known").when(bucket == 1, "partial").otherwise("unknown"))
    return recipes.probed_qa(recipes.selected_probes(classed), DATASET).select(*SHOWN)


# Text rules


def numbers_sql(x: str) -> str:
    out = f"lower({x})"
    for i, w in enumerate(T.NUMBER_WORDS):
        for _ in range(2):  # neighbours share a blank
            out = rf"regexp_replace({out}, '(^|[^\pL\pN_]){w}([^\pL\pN_]|$)', '\1{i}\2', 'g')"
    return out


NORM = lambda x: f"trim(regexp_replace({numbers_sql(x)}, '[^a-z0-9.]+', ' ', 'g'))"
PHRASE = " Two or THREE, ten twelve eleven."


@query(f"SELECT item_id, {numbers_sql('text || ' + chr(39) + PHRASE + chr(39))} AS out FROM benchmark")
def number_words(spark, d):
    return read(spark, d, "benchmark").select("item_id", T.number_words(F.concat("text", F.lit(PHRASE))).alias("out"))


@query(f"SELECT item_id, {NORM('text || ' + chr(39) + PHRASE + chr(39))} AS out FROM benchmark")
def normalized_text(spark, d):
    return read(spark, d, "benchmark").select("item_id", T.normalized(F.concat("text", F.lit(PHRASE))).alias("out"))


GENERIC = ", ".join(f"'{w}'" for w in T.GENERIC_ROLE_WORDS)


@query(f"SELECT item_id, array_to_string(list_filter(string_split({NORM('text || ' + chr(39) + ' maximum value' + chr(39))}, ' '), lambda t: t <> '' AND t NOT IN ({GENERIC})), '|') AS terms FROM benchmark")
def role_terms(spark, d):
    none = F.lit(None).cast("array<string>")
    return read(spark, d, "benchmark").select("item_id", F.array_join(T.role_terms(none, F.concat("text", F.lit(" maximum value"))), "|").alias("terms"))


@query(f"""WITH {QA}, t AS (SELECT conv_id, turn, conv_id % 13 AS x, list_transform(list_filter(string_split({NORM("answer || ' ratio is ' || conv_id % 9 || ' items'")}, ' '), lambda t: t <> ''), lambda t: trim(t, '.')) AS toks FROM qa)
SELECT conv_id, turn, len(list_filter(range(1, len(toks) + 1), lambda i: toks[i] = x::VARCHAR AND list_contains(toks[greatest(1, i - 3):i + 3], 'ratio') AND (list_contains(toks[greatest(1, i - 3):i + 3], 'item') OR list_contains(toks[greatest(1, i - 3):i + 3], 'items')))) > 0 AS present FROM t""")
def numeric_role_present(spark, d):
    reference = F.concat("answer", F.lit(" ratio is "), F.col("conv_id") % 9, F.lit(" items"))
    return pairs(spark, d).select("conv_id", "turn", T.numeric_role_present(reference, (F.col("conv_id") % 13).cast("string"), F.array(F.lit("ratio")), F.lit("item")).alias("present"))


MESSAGES = ["Credential refused", "403 FORBIDDEN", "rate limit hit", "Context too long", "unknown model x", "is disabled", "timed out", "unsupported thing", "odd reply", "network 429"]
FAMILIES_SQL = " ".join("WHEN " + " OR ".join(f"contains(m, '{w}')" for w in words) + f" THEN '{name}'" for name, words in T.ERROR_FAMILIES)


@query(f"WITH c AS (SELECT event_id, lower(list_value({', '.join(repr(m) for m in MESSAGES)})[event_id % 10 + 1]) AS m FROM events) SELECT event_id, CASE {FAMILIES_SQL} ELSE 'invalid_response' END AS category FROM c")
def error_category(spark, d):
    message = F.get(F.array(*map(F.lit, MESSAGES)), (F.col("event_id") % 10).cast("int"))
    return read(spark, d, "events").select("event_id", T.error_category(message).alias("category"))


@query(f"WITH c AS (SELECT event_type AS role, lower(list_value({', '.join(repr(m) for m in MESSAGES)})[event_id % 10 + 1]) AS m, event_id % 3 = 0 AS failed FROM events) SELECT role, CASE WHEN failed THEN 'failed' ELSE 'completed' END AS status, CASE WHEN failed THEN CASE {FAMILIES_SQL} ELSE 'invalid_response' END END AS failure_category, count(*) AS n FROM c GROUP BY ALL")
def call_status_counts(spark, d):
    message = F.get(F.array(*map(F.lit, MESSAGES)), (F.col("event_id") % 10).cast("int"))
    failed = F.col("event_id") % 3 == 0
    calls = read(spark, d, "events").select(F.col("event_type").alias("role"), F.when(failed, "failed").otherwise("completed").alias("status"), F.when(failed, T.error_category(message)).alias("failure_category"))
    return calls.groupBy("role", "status", "failure_category").agg(F.count("*").alias("n"))


# Qualification: stage outputs by rules over the pairs' numbers


def staged(spark, d: str) -> DataFrame:
    n = F.col("conv_id") * 7 + F.col("turn")
    spec = F.struct(
        F.lit("r1").alias("requirement_id"), F.lit("ratio limit").alias("semantic_role"), F.lit(None).cast("array<string>").alias("semantic_role_terms"),
        F.when(n % 3 == 0, "number").when(n % 3 == 1, "set").otherwise("exact_phrase").alias("value_type"), F.lit("").alias("unit"),
        F.when(n % 3 == 0, (n % 4).cast("string")).when(n % 3 == 2, F.when(n % 2 == 0, F.col("answer")).otherwise(F.col("question"))).alias("expected_value"),
        F.when(n % 3 == 1, F.array(F.col("answer"), F.when(n % 2 == 0, F.lit("quasar")).when(n % 5 == 0, F.col("question")).otherwise(F.lit("ratio")))).alias("expected_members"),
        F.lit(None).cast("string").alias("match_policy"), F.array().cast(f"array<{Q.QUALIFIER}>").alias("required_qualifiers"), F.lit(True).alias("expects"),
    )
    requirements = F.struct(F.when(n % 17 == 0, "uncertain").when(n % 13 == 0, "invalid").otherwise("valid").alias("question_validity"), F.lit("text").alias("answer_structure"), F.lit("source_explicit_only").alias("allowed_inference_policy"), F.array(spec).alias("requirements"))
    answerability = F.struct((n % 11 != 0).alias("answerable"), F.lit(None).cast("string").alias("allowed_inference_policy"), F.array().cast(f"array<{Q.SPEC}>").alias("bindings"), F.create_map().cast(f"map<string,{Q.SPEC}>").alias("slot_values"))
    flag = lambda name: F.lit(None).cast("boolean").alias(name)
    claims = {"unsupported_claims": 19, "contradicted_claims": 23}
    lists = [F.when(n % claims[x] == 0, F.array(F.lit("c"))).otherwise(F.array()).cast("array<string>").alias(x) if x in claims else F.array().cast("array<string>").alias(x) for x in Q.LISTS]
    qualification = F.struct(
        (n % 9 != 0).alias("answers_question"), F.when(n % 5 == 0, 0.5).otherwise(1.0).alias("required_slot_coverage"), F.array().cast(f"array<{Q.RESULT}>").alias("results"), F.lit(True).alias("unsupported_claims_material"),
        *[(n % 29 == 0).alias(x) if x == "premise_restatement" else flag(x) for x in Q.FLAGS], *lists, *[F.lit(None).cast("string").alias(x) for x in Q.AXES],
    )
    reference = F.concat("answer", F.lit(" ratio 2 and 3"))
    rows = pairs(spark, d).withColumn("n", n).select("conv_id", "turn", "n", "question", "answer", requirements.alias("requirements"), answerability.alias("answerability"), F.when(n % 31 != 0, qualification).alias("qualification"), reference.alias("reference"), (n % 37 != 0).alias("provenance_resolvable"))
    return rows


GATES = QA + f""", st AS (SELECT *, conv_id * 7 + turn AS n, {NORM("answer || ' ratio 2 and 3'")} AS ref FROM qa),
  g AS (SELECT *, n % 31 = 0 AS missing, list_filter([
    CASE WHEN n % 37 = 0 THEN 'provenance_unresolvable' END,
    CASE WHEN n % 3 = 0 THEN CASE WHEN n % 4 NOT IN (2, 3) THEN 'numeric_role_binding_failed' END
         WHEN n % 3 = 1 THEN CASE WHEN NOT contains(ref, {NORM("answer")}) OR n % 2 = 0 AND NOT contains(ref, 'quasar') OR n % 2 <> 0 AND n % 5 = 0 AND NOT contains(ref, {NORM("question")}) THEN 'missing_required_members' END
         ELSE CASE WHEN NOT contains(ref, CASE WHEN n % 2 = 0 THEN {NORM("answer")} ELSE {NORM("question")} END) THEN 'incomplete_exact_phrase' END END,
    CASE WHEN n % 29 = 0 THEN 'premise_restatement' END, CASE WHEN n % 19 = 0 THEN 'unsupported_claim' END, CASE WHEN n % 23 = 0 THEN 'contradicted_claim' END], lambda x: x IS NOT NULL) AS gates FROM st),
  dec AS (SELECT *, CASE WHEN missing THEN ['qualification_infrastructure_uncertainty'] ELSE list_filter([
    CASE WHEN n % 17 = 0 THEN 'question_validity_uncertain' WHEN n % 13 = 0 THEN 'question_invalid' END, CASE WHEN n % 11 = 0 THEN 'source_not_answerable_at_requested_specificity' END,
    CASE WHEN n % 9 = 0 THEN 'reference_does_not_answer_question' END, CASE WHEN n % 11 <> 0 AND n % 5 = 0 THEN 'missing_required_facts' END], lambda x: x IS NOT NULL) || gates END AS codes FROM g),
  decided AS (SELECT *, CASE WHEN missing OR n % 17 = 0 THEN 'needs_review' WHEN len(codes) > 0 THEN 'rejected' ELSE 'accepted' END AS decision,
    CASE WHEN n % 11 = 0 THEN 'not_assessable' WHEN n % 23 = 0 THEN 'incorrect' WHEN n % 9 <> 0 AND n % 5 <> 0 THEN 'correct' WHEN n % 9 <> 0 THEN 'partially_correct' ELSE 'incorrect' END AS correctness FROM dec)"""


@query(f"WITH {GATES} SELECT conv_id, turn, CASE WHEN n % 3 = 0 THEN n % 4 || ':number' WHEN n % 3 = 1 THEN ':set' ELSE CASE WHEN n % 2 = 0 THEN answer ELSE question END || ':exact_phrase' END AS merged FROM g")
def requirement_merge(spark, d):
    spec = F.get(Q.merged_specs(F.col("requirements"), F.col("answerability")), 0)
    return staged(spark, d).select("conv_id", "turn", F.concat(F.coalesce(spec["expected_value"], F.lit("")), F.lit(":"), spec["value_type"]).alias("merged"))


@query(f"WITH {GATES} SELECT conv_id, turn, array_to_string(gates, '|') AS codes FROM g WHERE NOT missing")
def gate_codes(spark, d):
    rows = staged(spark, d).where("qualification is not null")
    return rows.select("conv_id", "turn", F.array_join(Q.gate_codes(*map(F.col, ("requirements", "answerability", "qualification", "reference", "provenance_resolvable"))), "|").alias("codes"))


@query(f"WITH {GATES} SELECT conv_id, turn, decision, array_to_string(codes, '|') AS codes, CASE WHEN decision = 'accepted' THEN 'qualified' WHEN decision = 'needs_review' THEN 'not_determined' ELSE correctness END AS quality_label, CASE WHEN missing THEN 'not_assessable' ELSE correctness END AS reference_correctness FROM decided")
def qualification_decision(spark, d):
    return Q.decide(staged(spark, d)).select("conv_id", "turn", "decision", F.array_join("reason_codes", "|").alias("codes"), "quality_label", "reference_correctness")


@query(f"WITH {GATES} SELECT code, count(*) AS n FROM (SELECT unnest(codes) AS code FROM decided) GROUP BY code")
def reason_histogram(spark, d):
    return Q.decide(staged(spark, d)).select(F.explode("reason_codes").alias("code")).groupBy("code").agg(F.count("*").alias("n"))


@query(f"WITH {GATES}, acc AS (SELECT question, answer || ' ratio 2 and 3' AS answer, 'conv-' || conv_id AS source_asset_id, conv_id, turn, {ID('conv_id', 'turn')} AS candidate_id FROM decided WHERE decision = 'accepted')" + finish("acc", ID("'demo'", "candidate_id", "question", "answer"), "conv_id, turn, candidate_id") + SHOW)
def qualified_records(spark, d):
    none = F.array().cast("array<string>")
    rows = Q.decide(staged(spark, d)).select("*", H.deterministic_id(F.col("conv_id"), F.col("turn")).alias("candidate_id"), F.array(F.concat(F.lit("conv-"), "conv_id")).alias("source_asset_ids"), none.alias("document_ids"), none.alias("evidence_ids"), F.col("conv_id").alias("document_id"), F.col("turn").alias("char_start"))
    return recipes.qualified(rows.drop("answer"), DATASET).select(*SHOWN)


# Evaluation sets


@query("""SELECT doc_id, CASE WHEN doc_id % 23 = 0 THEN 'record_id_missing' WHEN lang = 'fr' THEN 'role_mismatch' WHEN doc_id % 5 = 0 THEN 'evaluation_record_marked_trainable'
  WHEN doc_id % 3 = 0 THEN 'group_missing' WHEN lang = 'es' THEN 'provenance_missing' END AS error FROM documents""")
def evaluation_rules(spark, d):
    n, lang = F.col("doc_id"), F.col("lang")
    rows = read(spark, d, "documents").select(
        n, F.when(n % 23 != 0, n.cast("string")).alias("record_id"), F.when(lang == "fr", "other").otherwise("paraphrase_evaluation").alias("research_role"), (n % 5 == 0).alias("training_eligible"),
        F.when(n % 3 != 0, lang).alias("fact_group_id"), F.lit(None).cast("string").alias("knowledge_unit_id"), F.when(lang != "es", F.lit("p")).alias("record_provenance"), F.lit(None).cast("string").alias("source_record_id"),
    )
    return rows.select("doc_id", E.rule_error("paraphrase_evaluation", rows.columns).alias("error"))


@query("SELECT item_id::VARCHAR AS record_id, 'evaluation' AS split, 'paraphrase_evaluation' AS research_role, false AS training_eligible, 'g' || item_id AS fact_group_id FROM benchmark")
def paraphrase_import(spark, d):
    rows = read(spark, d, "benchmark").select(F.col("item_id").cast("string").alias("record_id"), F.concat(F.lit("g"), "item_id").alias("fact_group_id"), F.lit("p").alias("record_provenance"))
    return E.normalise(rows, "paraphrase_evaluation").select("record_id", "split", "research_role", "training_eligible", "fact_group_id")


@query("""WITH p AS (SELECT doc_id AS id, lang, source FROM documents WHERE doc_id % 19 <> 0), r AS (SELECT doc_id AS id, lang, CASE WHEN doc_id % 29 = 0 THEN 'x' ELSE source END AS source FROM documents WHERE doc_id % 17 <> 0)
SELECT id, CASE WHEN p.lang IS NULL THEN 'unproven' WHEN r.lang IS NULL THEN 'unreferenced' ELSE 'conflict' END AS problem FROM p FULL JOIN r USING (id) WHERE p.lang IS DISTINCT FROM r.lang OR p.source IS DISTINCT FROM r.source""")
def provenance_coverage(spark, d):
    docs = read(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang", "source")
    return E.reconcile(docs.where("id % 19 <> 0"), docs.where("id % 17 <> 0").withColumn("source", F.when(F.col("id") % 29 == 0, "x").otherwise(F.col("source"))), "id", ["lang", "source"])


# Graph and handoff


@query("""WITH s AS (SELECT doc_id, lang AS node_id, CASE WHEN doc_id % 3 > 0 THEN doc_id % 4 END AS a, CASE WHEN doc_id % 2 > 0 THEN doc_id % 4 + 5 END AS b FROM documents), t AS (SELECT DISTINCT node_id, a, b FROM s WHERE doc_id % 5 > 0)
SELECT doc_id, t.node_id || ':' || coalesce(t.a::VARCHAR, '-') || ':' || coalesce(t.b::VARCHAR, '-') AS address_id FROM s JOIN t ON s.node_id = t.node_id AND s.a IS NOT DISTINCT FROM t.a AND s.b IS NOT DISTINCT FROM t.b""")
def null_safe_support(spark, d):
    n = F.col("doc_id")
    spans = read(spark, d, "documents").select("doc_id", F.col("lang").alias("node_id"), F.when(n % 3 > 0, n % 4).alias("char_start"), F.when(n % 2 > 0, n % 4 + 5).alias("char_end"))
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    addresses = spans.where("doc_id % 5 > 0").select("node_id", "char_start", "char_end").distinct().withColumn("address_id", F.concat_ws(":", "node_id", shown("char_start"), shown("char_end")))
    return G.null_safe_support(spans, addresses).select("doc_id", "address_id")


@query(f"WITH RECURSIVE {GRAPH} SELECT vertex FROM reach")
def gold_closure(spark, d):
    return reached(spark, d).select("vertex")


@query(f"WITH RECURSIVE {GRAPH} SELECT source_id, target_id, gold_eligible AND target_id IS NOT NULL AS allowed FROM rel WHERE source_id IN (SELECT vertex FROM reach)")
def closure_partition(spark, d):
    return G.partition(relations(spark, d), reached(spark, d)).select("source_id", "target_id", "allowed")


@query(f"WITH RECURSIVE {GRAPH} SELECT 's' || s_suppkey AS vertex FROM supplier WHERE 's' || s_suppkey NOT IN (SELECT vertex FROM reach)")
def unreachable_support(spark, d):
    return G.unreachable(read(spark, d, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("vertex")), reached(spark, d))


@query("SELECT n_regionkey, string_agg(n_name, chr(10) ORDER BY n_nationkey) AS division FROM nation GROUP BY n_regionkey")
def division_text(spark, d):
    rows = R.keep_ordered(read(spark, d, "nation"), ["n_regionkey"], "n_nationkey", "n_name", "names")
    return rows.select("n_regionkey", F.array_join("names", "\n").alias("division"))


@query("""WITH s AS (SELECT l_orderkey, list(l_linenumber ORDER BY l_linenumber, l_partkey) AS claims, list(l_partkey ORDER BY l_linenumber, l_partkey) AS members FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, (i - 1)::INT AS pos, claims[i] AS claim_id, members[i] AS member_id FROM (SELECT *, unnest(range(1, len(claims) + 1)) AS i FROM s)""")
def claims_zip(spark, d):
    both = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey")))
    sets = read(spark, d, "lineitem").groupBy("l_orderkey").agg(both.alias("x")).select("l_orderkey", F.transform("x", lambda y: y["l_linenumber"]).alias("claim_ids"), F.transform("x", lambda y: y["l_partkey"]).alias("member_ids"))
    return E.claims(sets, "claim_ids", "member_ids").select("l_orderkey", "pos", "claim_id", "member_id")


@query("SELECT event_id AS sequence, event_type FROM events WHERE event_id > 500")
def job_events_after(spark, d):
    from ..streaming.jobs import events_after

    return events_after(read(spark, d, "events").select(F.col("event_id").alias("sequence"), "event_type"), 500)


# Whole builds: through model calls, checkpoints and published shards


class RuleResponder:
    """Answers by rules that SQL can state: a unit for each sentence, its statement as answer, verdicts by lengths."""

    def respond(self, role: str, messages: list[dict[str, str]]) -> str:
        text = messages[-1]["content"]
        part = lambda name, end="": text.rpartition(f"{name}:\n")[2].partition(end)[0] if end else text.rpartition(f"{name}:\n")[2]
        match role:
            case "generator":
                return json.dumps({"instruction": recipes.ASK, "answer": text})
            case "knowledge_unit":
                return json.dumps({"knowledge_units": [{"canonical_statement": s} for s in text.split(".") if s.strip()]})
            case "qa_generator":
                unit = text.partition("KNOWLEDGE UNIT:\n")[2].partition("\n\nCITED EVIDENCE:\n")[0]
                return json.dumps({"instruction": recipes.ASK, "answer": json.loads(unit)["canonical_statement"] if "CITED EVIDENCE" in text else part("KNOWLEDGE UNIT")})
            case "validator":
                return json.dumps({"decision": "accept" if len(json.loads(part("CANDIDATE"))["answer"]) % 10 else "reject"})
            case "probe_generator":
                return json.dumps({"question": f"Is it so: {text}"})
            case "student":
                return "no idea"
            case "probe_judge":
                return json.dumps({"class": ("known", "partial", "unknown")[len(part("KNOWLEDGE UNIT", "\n\nSTUDENT RESPONSE:\n")) % 3], "reference_answer": "x"})
            case "requirements":
                return json.dumps({"required_slots": [], "answer_structure": "text"})
            case "answerability":
                return json.dumps({"answerable_at_requested_specificity": True})
            case "claim":
                return f"It is said: {text}"
        return json.dumps({"answers_question": len(json.loads(text)["reference"]) % 7 > 0, "required_slot_coverage": 1})


def built(spark, d: str, recipe: str) -> DataFrame:
    """The published records of a build over the documents with text."""
    store = ArtifactStore(scratch.scratch_path(spark, "build"), spark=spark)
    rows = evidence(spark, d).where(T.has_text(F.col("text")))
    got = B.build(spark, store, rows, recipe, C.parse('[models.generator]\nmodel = "rules"\n'), DATASET, "catalog", run_id="run", factory=RuleResponder)
    message, lineage = "struct<content:string,role:string>", "struct<split_group_id:string,research_role:string,training_eligible:boolean>"
    records = spark.read.schema(f"record_id string, split string, messages array<{message}>, metadata {lineage}").json([store.path(store.key(x["uri"])) for x in got["record_shards"]])
    return records.select("record_id", F.get("messages", F.lit(0))["content"].alias("question"), F.get("messages", F.lit(1))["content"].alias("answer"), "metadata.split_group_id", "split", "metadata.research_role", "metadata.training_eligible")


WHOLE_UNITS = EV + rf""", parts AS (SELECT *, string_split(text, '.') AS ps FROM ev WHERE regexp_matches(text, '\S')),
  each AS (SELECT * EXCLUDE (ps), i, {STRIP('ps[i]')} AS canonical_statement FROM (SELECT *, unnest(range(1, length(ps) + 1)) AS i FROM parts)),
  ku AS (SELECT *, {ID('evidence_id', 'canonical_statement')} AS knowledge_unit_id, row_number() OVER (PARTITION BY evidence_id ORDER BY i) AS pos, '{recipes.ASK}' AS question, canonical_statement AS answer FROM each WHERE canonical_statement <> ''),
  ok AS (SELECT *, {ID('knowledge_unit_id', '0', "'probe'")} AS probe_id FROM ku WHERE length(answer) % 10 > 0)"""


@query(f"{P1_RECORDS} {SHOW}")
def build_paragraph_qa(spark, d):
    return built(spark, d, "paragraph-qa")


@query(f"WITH {CAND}, accepted AS (SELECT * FROM cand WHERE length(answer) % 7 > 0)" + finish("accepted", ID("'demo'", "candidate_id", "question", "answer"), "document_id, char_start, candidate_id") + SHOW)
def build_paragraph_qa_qualified(spark, d):
    return built(spark, d, "paragraph-qa-qualified")


@query(f"WITH {WHOLE_UNITS}" + finish("ok", ID("'demo'", "knowledge_unit_id", "question", "answer"), "evidence_id, pos") + SHOW)
def build_knowledge_unit_qa(spark, d):
    return built(spark, d, "knowledge-unit-qa")


@query(f"WITH {WHOLE_UNITS}, sel AS (SELECT * FROM ok WHERE length(answer) % 3 > 0)" + finish("sel", ID("'demo'", ID("probe_id", "'judgment'"), "question", "answer"), "evidence_id, pos") + SHOW)
def build_knowledge_unit_probed_qa(spark, d):
    return built(spark, d, "knowledge-unit-probed-qa")


#: Stage outputs, good and bad, by stage; and whether they can be read.
OUTPUTS = {
    "requirements": [
        ('{"required_slots":["a","b"],"answer_structure":"text"}', True), ('{"required_slots":"a","answer_structure":"text"}', False), ('{"required_slots":[]}', False), ("[1]", False), ("no json", False),
        ('{"required_slots":[],"answer_structure":"x","question_validity":"odd"}', False), ('{"required_slots":[],"answer_structure":"x","requirements":[{"requirement_id":"r"},{"requirement_id":"r"}]}', False),
    ],
    "answerability": [
        ('{"answerable_at_requested_specificity":false,"slot_values":{"a":{"value":3},"b":["x"],"c":"y"}}', True), ('{"answerable_at_requested_specificity":"true"}', False), ('{"answerable_at_requested_specificity":true,"slot_values":[]}', False),
        ('{"answerable_at_requested_specificity":true,"evidence":[{"raw_source_text":"x"}]}', False), ('{"answerable_at_requested_specificity":true,"requirement_bindings":[{}]}', False), ('{"answerable_at_requested_specificity":true} x', False),
    ],
    "reference": [
        ('{"answers_question":true,"required_slot_coverage":1}', True), ('{"answers_question":true,"required_slot_coverage":true}', False), ('{"answers_question":1,"required_slot_coverage":1}', False),
        ('{"answers_question":true,"required_slot_coverage":1.5}', False), ('{"answers_question":true,"required_slot_coverage":0,"supported_claims":"x"}', False), ('{"answers_question":true,"answers_question":false,"required_slot_coverage":0.5}', True),
    ],
}


class EchoResponder:
    def respond(self, role: str, messages: list[dict[str, str]]) -> str:
        return messages[-1]["content"]


_READ = " UNION ALL ".join(f"SELECT '{stage}' AS stage, event_id, [{', '.join(str(ok).lower() for _, ok in texts)}][event_id % {len(texts)} + 1] AS ok FROM events" for stage, texts in OUTPUTS.items())


@query(f"SELECT stage, event_id, CASE WHEN ok THEN 'completed' ELSE 'failed' END AS status, CASE WHEN ok THEN 1 ELSE 2 END AS attempts, CASE WHEN NOT ok THEN 'invalid_response' END AS failure_category FROM ({_READ})")
def stage_outputs(spark, d):
    out = None
    for stage, texts in OUTPUTS.items():
        raw = F.get(F.array(*[F.lit(t) for t, _ in texts]), (F.col("event_id") % len(texts)).cast("int"))
        rows = read(spark, d, "events").select(F.col("event_id").cast("string").alias("candidate_id"), raw.alias("prompt"))
        kind = {"requirements": Q.REQUIREMENTS, "answerability": Q.ANSWERABILITY, "reference": Q.QUALIFICATION}[stage]
        told = M.ask(rows, M.Role(stage), "prompt", "", Q.PARSERS[stage], kind, EchoResponder, attempts=2)
        told = told.select(F.lit(stage).alias("stage"), F.col("candidate_id").cast("long").alias("event_id"), "call.status", "call.attempts", "call.failure_category")
        out = told if out is None else out.unionByName(told)
    return out


@query("""WITH d AS (SELECT doc_id, doc_id AS n FROM documents), c AS (SELECT doc_id, unnest([n, n + 1, n + 7]) AS m, unnest([0, 1, 2]) AS nth FROM d)
SELECT c.doc_id, string_agg(coalesce(t.text, ''), chr(10) ORDER BY nth) AS cited, array_to_string(list_sort(list(DISTINCT t.source)), '|') AS assets, 'enr-' || substr(sha256(concat_ws(chr(31), to_json(list_sort(list(DISTINCT md5(t.source))))::VARCHAR, '[]', 'unit')), 1, 32) AS enrichment
FROM c JOIN documents t ON t.doc_id = m GROUP BY c.doc_id""")
def unit_lineage(spark, d):
    name = lambda n: F.concat(F.lit("ev-"), n)
    cited = evidence(spark, d).drop("text").join(read(spark, d, "documents").select(name(F.col("doc_id")).alias("evidence_id"), F.coalesce("text", F.lit("")).alias("text")), "evidence_id").withColumn("source_sha256", F.md5("source_asset_id"))
    n = F.col("doc_id")
    units = read(spark, d, "documents").select(n.cast("string").alias("unit_row"), F.array(name(n), name(n + 1), name(n + 7)).alias("evidence_ids"))
    rows = S.enrichment_id(K.with_sources(K.cite(units, cited), cited, "unit_row"), "source_hashes", "source_anchor_ids", "unit")
    return rows.select(F.col("unit_row").cast("long").alias("doc_id"), "cited", F.array_join("source_asset_ids", "|").alias("assets"), F.col("enrichment_id").alias("enrichment"))


@query("SELECT doc_id, regexp_full_match(source || '/' || doc_id, '[A-Za-z0-9][A-Za-z0-9._-]{0,127}') AS dataset_id, regexp_full_match(source || ':' || doc_id, '[A-Za-z0-9][A-Za-z0-9._:-]{0,255}') AS handoff_id FROM documents")
def identifier_grammars(spark, d):
    whole = lambda pattern, sep: F.concat("source", F.lit(sep), "doc_id").rlike(f"^(?:{pattern.pattern})$")
    return read(spark, d, "documents").select("doc_id", whole(IDENTIFIER, "/").alias("dataset_id"), whole(H2.IDENTITY, ":").alias("handoff_id"))


from . import catalog_sources  # noqa: E402, F401  the queries of handoffs and provenance
