"""Language ID, toxicity, decontamination and the pipeline."""

import itertools
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from passagemill.llm import common, decontam, langid, line_dedup, packing, simhash, toxicity

from .conftest import ODD

# language ID


def plain_grams(text):
    words = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
    out = {}
    for n in (1, 2, 3):
        for i in range(len(words) - n + 1):
            g = words[i : i + n]
            if g != " ":
                out[g] = out.get(g, 0) + 1
    return out


@pytest.mark.parametrize("text", ["Ab, ab; éé 12 c", "x", "日本 語😀a", "  A  ", "a-b"])
def test_grams(text):
    values, counts = langid.grams(text)
    packed = {}
    for g, n in plain_grams(text).items():
        k = 0
        for c in g:
            k = k << 21 | ord(c)
        packed[k] = n
    assert dict(zip(values.tolist(), counts.tolist())) == packed


def test_no_letters():
    assert langid.Profiles({"en": [1]}, 9).predict("12 !?") == ("und", 0.0) == langid.Profiles({"en": [1]}, 9).predict(None)


def brute_predict(ranking, top, text):
    grams = plain_grams(text)
    key = lambda g: tuple(ord(c) for c in g)
    pack = lambda g: sum(ord(c) << 21 * i for i, c in enumerate(reversed(g)))
    mine = sorted(grams, key=lambda g: (-grams[g], pack(g)))[:top]
    far = {}
    for lang, known in ranking.items():
        far[lang] = sum(min(abs(known.index(pack(g)) - i), top) if pack(g) in known else top for i, g in enumerate(mine))
    assert key("a") == (97,)
    return min(sorted(far), key=far.get)


WORDS = {"en": "the of and thing with blewor", "fr": "le la de queaux ération été", "de": "der die und schung heit übe"}


def prose(rng, lang, n=60):
    return " ".join(rng.choice(WORDS[lang].split()) for _ in range(n))


def test_language_id(spark, docs):
    rng = random.Random(3)
    langs = {i: list(WORDS)[i % 3] for i in range(60)}
    texts = [prose(rng, langs[i]) for i in range(60)] + ODD
    df = docs(texts, langs=langs | {60 + i: None for i in range(len(ODD))}).withColumn("id", F.lit(1)).withColumn("gram", F.lit(2))
    got = {r.doc_id: r for r in langid.language_id(df).collect()}
    assert len(got) == len(texts) and all(0 <= r.score <= 1 for r in got.values())
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    assert all(got[i].lang_pred == langs[i] for i in range(60))
    ranking = langid.profiles(df)
    for i, t in enumerate(texts):
        if t and any(c.isalpha() for c in t) and len(t) < 1000:
            assert got[i].lang_pred == brute_predict(ranking, langid.TOP, t)
        elif not t or not any(c.isalpha() for c in t):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert langid.language_id(docs([])).count() == 0
    assert {r.lang_pred for r in langid.language_id(docs(["a b"], langs={0: None})).collect()} == {"und"}


# toxicity


def test_transducers():
    kinds = lambda text: toxicity.Grammar({"idiot": "insult", "moro*": "insult", "zap": "threat"})(text)
    assert kinds("An idiot passes") == {"insult": 1}
    assert kinds("You idiot. A table") == {"targeted": 1}
    assert kinds("an idiot are you") == {"targeted": 1}
    assert kinds("That is not an idiot!") == {"negated": 1}
    assert kinds("He wrote: idiot") == {"insult": 1}  # the clause ends at the colon
    assert kinds("it said such a moron") == {"reported": 1}
    assert kinds("I will kill it") == {"threat": 1} and kinds("kill it") == {} and kinds("zap it") == {"threat": 1}
    assert kinds("they never will kill anything") == {"negated": 1}
    assert kinds(None) == kinds("idiotic") == {}


def brute_matches(classes):
    """The grammar's rules read off the places of words."""
    found = {}
    for i, c in enumerate(classes):
        before = classes[max(0, i - toxicity.REACH) : i]
        around = before + classes[i + 1 : i + 1 + toxicity.REACH]
        if c == "insult" or c == "threat" or c == "harm" and "intent" in before:
            plain = ("targeted" if "target" in around else "insult") if c == "insult" else "threat"
            kind = "negated" if "negation" in before else "reported" if "report" in before else plain
            found[kind] = found.get(kind, 0) + 1
    return found


def test_the_composed_machine_against_its_rules():
    rng = random.Random(6)
    for _ in range(3000):
        classes = rng.choices(toxicity.CLASSES, [3, 2, 1, 1, 1, 1, 2, 6], k=rng.randrange(0, 14))
        assert toxicity.matches(classes) == brute_matches(classes), classes
    assert len(toxicity.CLASSES) == 8 and len({s for s, _ in toxicity.MACHINE.arcs}) <= 5**4


def test_odds_are_chosen_by_what_they_tell():
    assert toxicity.choose_odds([(1, 300.0, 9), (1, 20.0, 1), (0, 10.0, 50), (0, 0.0, 100)]) == 16.0
    assert toxicity.choose_odds([(1, 900.0, 9), (0, 100.0, 5)]) == 256.0


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.1/labels.parquet"), reason="the driver's tables are not here")
def test_held_out_toxicity_of_the_driver_s_table(spark):
    d = "/root/testdata/sf0.1"
    told = common.table(spark, d, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = toxicity.op8_toxicity(spark, d).join(told, "doc_id").where("held_out").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in rows}
    recall, clean = n[1, 1] / (n[1, 1] + n.get((1, 0), 0)), n[0, 0] / (n[0, 0] + n.get((0, 1), 0))
    assert recall >= 0.9 and clean >= 0.99, n


def toxic_corpus(n=400):
    rng = random.Random(9)
    texts, labels = [], []
    for i in range(n):
        words = [f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(30)]
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(30), rng.choice(["blorg", "zwickheit", "zwickung", "zwickbar"]))
        texts.append(" ".join(words))
        labels.append((i, toxic))
    return texts, labels


def test_toxicity_is_learned(spark, docs):
    texts, labels = toxic_corpus()
    told = spark.createDataFrame([*labels, (None, 1), (0, None)], "doc_id long, toxic int")
    df = docs(texts + ODD).withColumn("key", F.lit(1)).withColumn("label", F.lit(2)).withColumn("score", F.lit(3))
    rows = {r.doc_id: r for r in toxicity.toxicity(df, told).collect()}
    assert len(rows) == len(texts) + len(ODD) and all(0 <= r.score <= 1 for r in rows.values())
    held = [i for i, _ in labels if rows[i].held_out]
    assert held and all(rows[i].predicted == dict(labels)[i] for i in held)
    assert all(rows[len(texts) + i].predicted == 0 for i in range(len(ODD)))
    lexicon, arcs, weights = toxicity.train(df, told)
    assert lexicon["blorg"] == "insult" == lexicon["zwick*"] and min(weights[1:]) >= 0 and arcs["insult"] > 0
    none = toxicity.toxicity(df, told.limit(0))
    assert {r.predicted for r in none.collect()} == {0}
    assert toxicity.toxicity(docs([]), told).count() == 0


def test_threats_are_learned(spark, docs):
    rng = random.Random(4)
    word = lambda: f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}"
    texts = [" ".join([word() for _ in range(20)] + (["i", "will", "zarp", word()] if i % 4 == 0 else []) + [word() for _ in range(5)]) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    lexicon, arcs, _ = toxicity.train(docs(texts), labels)
    assert lexicon["zarp"] == "threat" and arcs["threat"] > 0


def test_copies_do_not_make_an_insult(spark, docs):
    texts = [f"plain words number {chr(97 + i % 26)} here" for i in range(200)] + ["a copied text with oddword inside"] * 40
    labels = spark.createDataFrame([(i, int(i >= 200)) for i in range(240)], "doc_id long, toxic int")
    assert "oddword" not in toxicity.train(docs(texts), labels)[0]


# decontamination


def brute_overlap(words, item):
    best = 0
    for offset in range(-len(item) + 1, len(words)):
        best = max(best, sum(0 <= offset + i < len(words) and words[offset + i] == w for i, w in enumerate(item)))
    return best / len(item)


def survives(length, changed):
    """Whether an item with these places changed still has a window under a mask of its family."""
    good = [i not in changed for i in range(length)]
    return any(all(good[at + i] for i, c in enumerate(m) if c == "1") for m in decontam.masks_of(length) for at in range(length - len(m) + 1))


def test_no_substitution_hides_a_short_item():
    for length in range(1, 17):
        assert all(survives(length, c) for c in itertools.combinations(range(length), length // 5))


def test_recall_of_the_masks():
    rng = random.Random(1)
    for length in range(17, 61):
        found = sum(survives(length, rng.sample(range(length), length // 5)) for _ in range(500))
        assert found >= 495, (length, found)


def benchmark_and_docs():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    items = [[word() for _ in range(rng.choice([4, 12, 25, 40]))] for _ in range(12)]
    texts = []
    for k in range(60):
        body = [word() for _ in range(50)]
        if k % 2:
            item = list(rng.choice(items))
            for _ in range(rng.choice([0, 0, 1, 3])):
                item[rng.randrange(len(item))] = word()
            body[20:20] = item[: rng.choice([len(item), len(item), len(item) // 2])]
        texts.append(" ".join(body))
    return [" ".join(i) for i in items], texts


@pytest.mark.parametrize("broadcast_seeds", [2_000_000, 0])
def test_decontamination_against_brute_force(spark, docs, broadcast_seeds):
    items, texts = benchmark_and_docs()
    texts = texts + ODD
    bench = spark.createDataFrame([*enumerate(items), (90, None), (91, "..."), (None, "nullid words of an item here")], "item_id long, text string")
    df = docs(texts).withColumn("held", F.lit(1)).withColumn("items", F.lit(2)).withColumn("key", F.lit(3)).withColumn("row", F.lit(3))
    got = {r.held.doc_id: r for r in decontam.contamination(df, bench, broadcast_seeds=broadcast_seeds).collect()}
    assert len(got) == len(texts) and got[0].held.key == 3
    for i, t in enumerate(texts):
        words = decontam.WORD.findall((t or "").lower())
        want = [k for k, x in enumerate(items) if words and len(words) < 5000 and brute_overlap(words, decontam.WORD.findall(x)) >= 0.8]
        assert list(got[i]["items"]) == want and (got[i].most >= 0.8) == bool(want)
    assert decontam.contamination(docs([]), bench, broadcast_seeds=broadcast_seeds).count() == 0
    assert decontam.contamination(docs(["a"]), bench.limit(0), broadcast_seeds=broadcast_seeds).first().most == 0.0


def test_decontamination_of_gaps_stretches_and_other_ids(spark, docs):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    item, long = [word() for _ in range(30)], [word() for _ in range(200)]
    body = [word() for _ in range(40)]
    texts = [" ".join(body + x + body) for x in ([*item[:15], "zz", *item[15:]], item[:14] + item[15:], item[:20], long[40:110], long[40:80], [])]
    bench = spark.createDataFrame([("a:b", " ".join(item)), ("c", " ".join(long))], "item_id string, text string")
    got = decontam.contamination(docs(texts + [texts[0]]), bench).collect()
    assert [list(r["items"]) for r in sorted(got, key=lambda r: r.held.doc_id)] == [["a:b"], ["a:b"], [], ["c"], [], [], ["a:b"]]
    nobody = spark.createDataFrame([(None, texts[0]), (None, "x")], "doc_id long, text string")
    assert sorted(len(r["items"]) for r in decontam.contamination(nobody, bench).collect()) == [0, 1]


# the pipeline


def test_pipeline_against_its_stages_done_by_hand(spark, docs, tmp_path):
    texts, labels = toxic_corpus(200)
    items, leaky = benchmark_and_docs()
    rng = random.Random(4)
    long_line = "a line of licence text that very many of the documents share"
    base = " ".join(f"v{rng.randrange(999)}" for _ in range(400))
    texts += leaky + [base, base + " more", base.replace("v1", "u1", 1)] + [f"{prose(rng, 'en', 40)}\n{long_line}" for _ in range(6)] + [None, "", "tiny"]
    for name, df in {"documents": docs(texts), "labels": spark.createDataFrame(labels, "doc_id long, toxic int"), "benchmark": spark.createDataFrame(list(enumerate(items)), "item_id long, text string")}.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    d = str(tmp_path)
    state = common.table(spark, d, "documents")
    columns, rows = state.columns, {r.doc_id: r.text for r in state.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_dedup", "decontamination", "best_fit_packing"]

    scores = {r.doc_id: r.predicted for r in toxicity.toxicity(state, common.table(spark, d, "labels")).collect()}
    state = common.materialize(corpus_pipeline.STAGES[0][1](spark, state, d), "t0")
    rows = {i: t for i, t in rows.items() if not scores[i]}
    assert state.columns == columns and {r.doc_id: r.text for r in state.collect()} == rows

    report = {r.doc_id: {int(x) for x in r.dropped.split(",") if x} for r in line_dedup.line_report(state).collect()}
    state = common.materialize(corpus_pipeline.STAGES[1][1](spark, state, d), "t1")
    rows = {i: None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in report[i]) for i, t in rows.items()}
    got = {r.doc_id: (r.text, r.n_chars) for r in state.collect()}
    assert state.columns == columns and {i: t for i, (t, _) in got.items()} == rows
    assert all(n == (None if t is None else len(t)) for t, n in got.values())
    assert sum(long_line in (t or "") for t in rows.values()) == 1

    prints = {i: simhash.fingerprint((t or "").encode()) for i, t in rows.items()}
    root = {i: i for i in rows}
    for i in sorted(rows):
        for j in sorted(rows):
            if j < i and bin(prints[i] ^ prints[j]).count("1") <= 2:
                a, b = root[i], root[j]
                root = {k: min(a, b) if v in (a, b) else v for k, v in root.items()}
    state = common.materialize(corpus_pipeline.STAGES[2][1](spark, state, d), "t2")
    rows = {i: t for i, t in rows.items() if root[i] == i}
    assert state.columns == columns and {r.doc_id for r in state.collect()} == set(rows)

    bad = {r.held.doc_id for r in decontam.contamination(state, common.table(spark, d, "benchmark")).where(F.size("items") > 0).collect()}
    state = common.materialize(corpus_pipeline.STAGES[3][1](spark, state, d), "t3")
    rows = {i: t for i, t in rows.items() if i not in bad}
    assert bad and state.columns == columns and {r.doc_id: r.text for r in state.collect()} == rows

    packed = corpus_pipeline.run(spark, d).collect()
    encoder = packing.ChunkEncoder(packing.tokenizer_path(packing.TOKENIZER))
    want = {i: len(encoder.encode((t or "").encode())) // 4 + 1 for i, t in rows.items()}
    lengths = {}
    for r in packed:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths == want and np.all([r.offset + r.length <= 2048 for r in packed])
