import random
import time

import pytest
from pyspark.sql import functions as F

from passagemill.llm import line_dedup as ld

from .conftest import ODD


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, text, n):
    for _ in range(n):
        i = rng.randrange(len(text)) if text else 0
        text = rng.choice([text[:i] + text[i + 1 :], text[:i] + rng.choice("abé😀") + text[i:], text[:i] + rng.choice("abé😀") + text[i + 1 :]])
    return text


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance_and_keys(spark, edits):
    rng = random.Random(edits)
    pairs = []
    for _ in range(300):
        a = "".join(rng.choice("abcé") for _ in range(rng.choice([0, 1, 2, 5, 12, 40])))
        b = edited(rng, a, rng.randint(0, edits + 2)) if a else "".join(rng.choice("ab") for _ in range(rng.randint(0, 3)))
        pairs.append((a, b))
    kind = F.lit(False)
    arrays = spark.createDataFrame(pairs, "s string, t string").select("s", "t", ld.symbols(F.col("s"), 99).alias("a"), ld.symbols(F.col("t"), 99).alias("b"))
    a, b = F.col("a"), F.col("b")
    keys = lambda f, x: F.filter(F.array(*f(F.col(x), kind, F.length(x), edits)), lambda k: k.isNotNull())
    df = ld.with_distance(arrays, edits).select(
        F.col("s"), F.col("t"), ld.banded_distance(a, b, edits).alias("d"), ld.banded_distance(b, a, edits).alias("e"),
        keys(ld.index_keys, "s").alias("ia"), keys(ld.index_keys, "t").alias("ib"), keys(ld.probe_keys, "s").alias("pa"), keys(ld.probe_keys, "t").alias("pb"),
        F.coalesce(F.col("distance") <= edits, F.lit(False)).alias("alike"),
    )
    for r in df.collect():
        want = distance(r.s, r.t)
        assert (r.d, r.e) == (want, want) if want <= edits else min(r.d, r.e) > edits, (r.s, r.t, want, r.d, r.e)
        assert r.alike == (want <= edits), (r.s, r.t)
        if want <= edits and min(len(r.s), len(r.t)) > edits:
            short, own = (r.ia, r.pb + r.ib) if len(r.s) <= len(r.t) else (r.ib, r.pa + r.ia)
            assert set(short) & set(own), (r.s, r.t)


def brute(texts, edits, min_chars, words):
    lines = [(i, p, x) for i, t in enumerate(texts) if t is not None for p, x in enumerate(t.split("\n")) if x.strip(" \t\x0b\f\r")]
    distinct = sorted({x for *_, x in lines}, key=lambda x: min(y[:2] for y in lines if y[2] == x))
    root = {x: x for x in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def symbols(x):
        return (True, x.split(" ")) if len(x.split(" ")) >= words else (False, list(x))

    long = [x for x in distinct if min_chars <= len(x) <= 2000]
    for i, x in enumerate(long):
        for y in long[:i]:
            (k, a), (m, b) = symbols(x), symbols(y)
            if k == m and abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                p, q = sorted((find(x), find(y)), key=distinct.index)
                root[q] = p
    first = {}
    for i, p, x in sorted(lines):
        first.setdefault(find(x), (i, p))
    return {i: [p for j, p, x in lines if j == i and first[find(x)] != (j, p)] for i in range(len(texts))}


@pytest.mark.parametrize("edits,hot,words", [(1, 64, 12), (1, 1, 12), (1, 1, 4), (2, 64, 12)])
def test_against_brute_force(spark, docs, edits, hot, words):
    rng = random.Random(7)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.choice([24, 25, 33, 60]))) for _ in range(6)]
    base += [" ".join(rng.choice(["one", "two", "three", "", "five"]) for _ in range(rng.choice([12, 13, 20]))) for _ in range(3)]

    def changed(x):
        if rng.random() < 0.5:
            return edited(rng, x, rng.choice([0, 1, 1, 2]))
        w = x.split(" ")
        w[rng.randrange(len(w))] = rng.choice(["other", "words at", "x"])
        return " ".join(w)

    texts = ["\n".join([rng.choice(["short", "", " "]), *(changed(rng.choice(base)) for _ in range(3)), rng.choice(base)]) for _ in range(16)]
    texts = ODD + texts
    df = docs(texts).repartition(3)
    got = {r.doc_id: r for r in ld.line_report(df, edits=edits, hot=hot, words=words).collect()}
    want = brute(texts, edits, ld.MIN_CHARS, words)
    for i, t in enumerate(texts):
        assert got[i].dropped == ",".join(map(str, want[i])), (i, t)
        assert (got[i].n_dropped, got[i].n_lines) == (len(want[i]), 0 if t is None else t.count("\n") + 1)
    if (hot, edits, words) == (64, 1, 12):
        kept = {r.doc_id: r.text for r in ld.stage(spark, df, "").collect()}
        for i, t in enumerate(texts):
            assert kept[i] == (None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in want[i]))


def test_near_copies_of_a_very_long_line(spark, docs):
    rng = random.Random(1)
    base = "".join(rng.choice("abcdefgh") for _ in range(100_000))
    texts = [base[:i] + "X" + base[i + 1 :] for i in rng.sample(range(100_000), 69)] + [base]
    began = time.time()
    got = {r.doc_id: r for r in ld.line_report(docs(texts), hot=8).collect()}
    assert [got[i].n_dropped for i in range(70)] == [0] + [1] * 69 and time.time() - began < 60


def test_words_are_not_taken_for_characters(spark, docs):
    letters = [chr(97 + i) for i in range(25)]
    texts = [" ".join(letters), "".join(letters), " ".join(letters[:-1]), "".join(letters[:-1]), " ".join(letters[1:]), "".join(letters[1:])]
    got = {r.doc_id: r.n_dropped for r in ld.line_report(docs(texts), hot=1).collect()}
    assert got == {0: 0, 1: 0, 2: 1, 3: 1, 4: 1, 5: 1}


def test_a_text_of_very_many_repeated_lines(spark, docs):
    began = time.time()
    got = {r.doc_id: r.text for r in ld.line_dedup(docs(["again\n" * 100_000 + "new", "again"])).collect()}
    assert got == {0: "again\n\nnew".replace("\n\n", "\n"), 1: ""} and time.time() - began < 60


def test_odd_tables(spark, docs):
    assert ld.line_report(docs([])).count() == 0
    line = "a line that is long enough to count"
    df = spark.createDataFrame([(None, line), (1, line), (1, line), (2, line + "\n" + line + "!")], "doc_id long, text string")
    df = df.withColumn("line", F.lit(1)).withColumn("d", F.lit(2)).withColumn("pos", F.lit(3)).withColumn("dropped", F.lit(4))
    got = sorted((str(r.doc_id), r.dropped, r.n_near) for r in ld.line_report(df).collect())
    assert got == [("1", "0", 0)] * 2 + [("2", "0,1", 1), ("None", "", 0)]
    assert ld.line_dedup(df).columns == df.columns
