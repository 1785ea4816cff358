"""Null ids, repeated rows, ties, clashing names and empty tables through operators, stages and the pipeline."""

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from passagemill.llm import common, decontam, langid, near, packing, simhash, toxicity

from .conftest import DOC_SCHEMA
from .test_text_models import brute_predict, plain_grams

CLASHING = ("id", "row", "set", "held", "key", "salt", "_salt", "length", "part", "local", "rank", "fp", "u", "v", "score", "items", "text2", "n", "deal")
ROWS = [
    (None, "one two three four five six", "en", "s", 1),
    (None, "one two three four five six", "en", "s", 1),
    (None, None, None, None, None),
    (3, None, "en", None, None),
    (3, None, "en", None, None),
    (4, "", None, "s", 0),
    (5, "seven eight nine ten eleven", None, None, None),
    (5, "another text under the same id", "de", "s", 3),
]


@pytest.fixture
def odd(spark):
    df = spark.createDataFrame(ROWS, DOC_SCHEMA)
    for k, name in enumerate(CLASHING):
        df = df.withColumn(name, F.lit(k))
    return df.repartition(3)


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(None, 1), (3, None), (4, 0), (4, 0), (5, 1), (9, 0)], "doc_id long, toxic int")


def ids(rows):
    return Counter(r.doc_id for r in rows)


def test_every_row_gets_a_row(spark, odd, labels):
    want = Counter(r[0] for r in ROWS)
    bench = spark.createDataFrame([(1, "seven eight nine ten eleven"), (1, None), (None, "")], "item_id long, text string").withColumn("h", F.lit(1)).withColumn("item", F.lit(2))
    prints = simhash.simhash_components(odd).collect()
    assert ids(prints) == want
    assert {r.component_id for r in prints if r.fingerprint == "0" * 16} == {3}
    assert ids(langid.language_id(odd).collect()) == want
    assert ids(toxicity.toxicity(odd, labels).collect()) == want
    told = decontam.contamination(odd, bench).collect()
    assert Counter(r.held.doc_id for r in told) == want and [r.held.doc_id for r in told if r["items"]] == [5]
    packed = packing.pack(odd).collect()
    assert ids(packed) == want and sum(r.length for r in packed) > len(ROWS)
    # equal rows get equal results
    assert len({(r.fingerprint, r.component_id) for r in prints if r.doc_id == 3}) == 1


@pytest.mark.parametrize("operator", [simhash.simhash_components, langid.language_id, packing.pack, near.near_dedup])
def test_empty_tables(spark, odd, operator):
    assert operator(odd.limit(0)).count() == 0 and operator(spark.createDataFrame([], DOC_SCHEMA)).count() == 0


def write(folder, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_stages_keep_rows_without_ids_and_all_columns(spark, odd, labels, tmp_path):
    bench = spark.createDataFrame([(1, "seven eight nine ten eleven")], "item_id long, text string")
    d = write(tmp_path, documents=odd, labels=labels, benchmark=bench)
    docs = common.table(spark, d, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, d), name)
        assert docs.columns == odd.columns
        kept[name] = ids(docs.collect())
    assert kept["toxicity"] == Counter(r[0] for r in ROWS) == kept["line_dedup"]
    # the line of the two rows without an id stays once, and so does one text without words
    assert kept["simhash_dedup"] == {None: 1, 3: 1, 5: 2} and kept["decontamination"] == {None: 1, 3: 1, 5: 1}
    assert ids(corpus_pipeline.run(spark, d).collect()) == kept["decontamination"]


def test_the_pipeline_of_an_empty_table(spark, labels, tmp_path):
    bench = spark.createDataFrame([], "item_id long, text string")
    d = write(tmp_path, documents=spark.createDataFrame([], DOC_SCHEMA), labels=labels.limit(0), benchmark=bench)
    assert corpus_pipeline.run(spark, d).count() == 0


# language ID, from training to prediction


def test_language_id_is_what_brute_force_learns_and_predicts(spark, docs, monkeypatch):
    texts = ["der die das und", "the of and the", "le la les des", "das ist und der", "and of to the", "les de la une", "x", "the die la", "und the les of", ""] * 4
    langs = {i: None if i % 10 > 5 else ["de", "en", "fr"][i % 3] for i in range(len(texts))}
    top = 12
    counts = {}
    for i, t in enumerate(texts):
        if langs[i] and zlib.crc32(str(i).encode()) % 5:
            counts.setdefault(langs[i], Counter()).update(plain_grams(t))
    pack = lambda g: sum(ord(c) << 21 * k for k, c in enumerate(reversed(g)))
    ranking = {lang: [pack(g) for g in sorted(c, key=lambda g: (-c[g], pack(g)))[:top]] for lang, c in counts.items()}
    df = docs(texts, langs=langs)
    assert langid.profiles(df, top=top) == ranking
    got = {r.doc_id: r for r in langid.language_id(df, top=top).collect()}
    for i, t in enumerate(texts):
        assert got[i].lang_pred == (brute_predict(ranking, top, t) if t else "und")

    whole = [langid.grams(t) for t in ("ab, cd  ef" * 9, "日本 a", "  ", "é" * 30)]
    monkeypatch.setattr(langid, "CHUNK", 3)
    for (values, numbers), t in zip(whole, ("ab, cd  ef" * 9, "日本 a", "  ", "é" * 30)):
        again = langid.grams(t)
        assert again[0].tolist() == values.tolist() and again[1].tolist() == numbers.tolist()


@pytest.mark.skipif(not __import__("os").path.exists("/root/testdata/sf0.01/documents.parquet"), reason="the driver's tables are not here")
def test_held_out_languages_of_the_driver_s_table(spark):
    d = "/root/testdata/sf0.01"
    told = common.table(spark, d, "documents").select("doc_id", "lang")
    rows = langid.op7_language_id(spark, d).join(told, "doc_id").where("held_out and lang is not null and lang_pred <> 'und'")
    right, n = rows.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert n > 100 and right >= 0.95 * n, (right, n)
