import random

import pytest

from passagemill.llm import near, simhash

from .conftest import ODD


def plain_set(text, width=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(texts):
    """The smallest index of each component."""
    sets, root = [plain_set(t) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x == y or len(x & y) * 5 >= len(x | y) * 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {find(i) for i in range(len(texts))}


def changed(rng, text, n):
    words = text.split(" ")
    for i in rng.sample(range(len(words)), n):
        words[i] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("hot", [64, 4])
def test_near_dedup_against_brute_force(spark, docs, hot):
    rng = random.Random(3)
    base = [" ".join(f"w{rng.randrange(9999)}" for _ in range(rng.choice([60, 200, 400]))) for _ in range(8)]
    # five shingles a changed word: similarities from 0.5 to 1, some of them next to 0.8
    texts = ODD + base + [changed(rng, t, k) for t in base for k in (1, 2, 3, len(t.split()) // 50, len(t.split()) // 40, len(t.split()) // 15)]
    # with large groups of near copies
    texts += [changed(rng, base[0], 1) for _ in range(30)]
    got = [r.doc_id for r in near.near_dedup(docs(texts).repartition(3), hot=hot).collect()]
    assert sorted(got) == sorted(brute(texts))


def test_crowded_bands_lose_nothing(spark, docs):
    """300 near copies, each next to 0.8 of the base: far fewer are alike with each other than with it."""
    rng = random.Random(8)
    base = " ".join(f"w{rng.randrange(9999)}" for _ in range(250))
    texts = [base] + [changed(rng, base, rng.choice([2, 3, 4, 5])) for _ in range(300)]
    assert {r.doc_id for r in near.near_dedup(docs(texts), hot=8).collect()} == brute(texts)


def test_the_stage_drops_copies_that_differ_in_more_than_two_bits(spark, docs):
    rng = random.Random(4)
    base = [" ".join(f"w{rng.randrange(9999)}" for _ in range(300)) for _ in range(10)]
    copies = [changed(rng, t, 5) for t in base]
    far = [bin(simhash.fingerprint(a.encode()) ^ simhash.fingerprint(b.encode())).count("1") > 2 for a, b in zip(base, copies)]
    assert any(far)
    stayed = near.stage(spark, docs(base + copies), "")
    assert stayed.columns == docs([]).columns
    assert sorted(r.doc_id for r in stayed.collect()) == list(range(10))
    assert near.stage(spark, docs([]), "").count() == 0


def test_rows_without_an_id_stay_unless_a_copy_stays(spark):
    rows = [(None, "no id and alone"), (None, "no id but a copy"), (7, "no id but a copy"), (None, "twice without"), (None, "twice without"), (5, "one id, two texts"), (5, "the other one"), (6, "same row"), (6, "same row")]
    got = near.stage(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "").collect()
    want = [(None, "no id and alone"), (7, "no id but a copy"), (None, "twice without"), (5, "one id, two texts"), (5, "the other one"), (6, "same row")]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("block", [256, 16])
def test_no_pair_of_a_crowded_band_is_lost(spark, docs, block):
    """150 chains base - middle - end: ends are alike with their middle only, so no few pivots of a crowded band lead to them."""
    rng = random.Random(5)
    base = " ".join(f"w{rng.randrange(9999)}" for _ in range(250))
    texts = [base]
    for _ in range(150):
        texts.append(changed(rng, base, 4))
        texts.append(changed(rng, texts[-1], 4))
    want = brute(texts)
    got = {r.doc_id for r in near.near_dedup(docs(texts), hot=8, block=block).collect()}
    assert got == want and len(want) < 10
