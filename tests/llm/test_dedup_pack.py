import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from passagemill.llm import exact_dedup, near, packing, simhash
from passagemill.llm.components import components

from .conftest import ODD

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# exact dedup


@pytest.mark.parametrize("parts", [1, 5])
def test_exact_dedup_against_brute_force(spark, docs, parts):
    texts = [*ODD, "The same", "the SAME", "É", "é", *["copy"] * 40]
    got = {r.doc_id: r for r in exact_dedup.exact_dedup(docs(texts).repartition(parts)).collect()}
    keys = [(t or "").translate(LOW) for t in texts]
    for i, k in enumerate(keys):
        same = [j for j, x in enumerate(keys) if x == k]
        assert got[i][1:] == (max(same), len(same), i == max(same), hashlib.sha256(k.encode()).hexdigest())


def test_exact_dedup_empty_clashing_names_and_null_ids(spark, docs):
    assert exact_dedup.exact_dedup(docs([])).count() == 0
    df = docs(["a", "b"]).withColumn("digest", F.lit(1)).withColumn("salt", F.lit(1)).withColumn("keep_id", F.lit(1)).withColumn("content", F.lit("z"))
    assert sorted(r.keep_id for r in exact_dedup.exact_dedup(df).collect()) == [0, 1]
    nulls = spark.createDataFrame([(None, "q"), (None, "q"), (3, "r"), (3, "r")], "doc_id long, text string")
    got = [tuple(r)[:4] for r in exact_dedup.exact_dedup(nulls).collect()]
    assert sorted(got, key=str) == [(3, 3, 2, True)] * 2 + [(None, None, 2, True)] * 2


def test_equal_digests_are_told_apart_by_content(spark, docs, monkeypatch):
    class Weak:
        def __init__(self, data):
            self.data = bytes(data)

        def digest(self):
            return self.data[:1]

    class Module:
        sha256 = Weak

    monkeypatch.setattr(exact_dedup, "_normalised", lambda with_text: _weak(with_text))

    def _weak(with_text):
        def run(batches):
            import pyarrow as pa

            for b in batches:
                t = [x or "" for x in b.column(1).to_pylist()]
                cols = [b.column(0), pa.array([x[:1].encode() for x in t], pa.binary())] + ([pa.array(t, pa.string())] if with_text else [])
                yield pa.RecordBatch.from_arrays(cols, ["id", "digest"] + (["content"] if with_text else []))

        return run

    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_dedup(docs(["ab", "ac", "ab", "b"])).collect()}
    assert got == {0: (2, 2), 2: (2, 2), 1: (1, 1), 3: (3, 1)}


# SimHash


def plain_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "cé", "😀", "dd", "\t", "e\x1cf", " "]), max_size=600))
def test_fingerprint(words):
    assert simhash.fingerprint(" ".join(words).encode()) == plain_fingerprint(" ".join(words))


def brute_components(points):
    root = list(range(len(points)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(points)):
        for j in range(i):
            if bin(points[i] ^ points[j]).count("1") <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(points))]


@pytest.mark.parametrize("hot", [2, 64])
def test_links_connect_what_brute_force_does(spark, hot):
    rng = random.Random(5)
    points = [rng.getrandbits(64) for _ in range(40)]
    for p in points[:20]:
        q = p
        for _ in range(8):
            q ^= 1 << rng.randrange(64)
            if rng.random() < 0.6:
                q ^= 1 << rng.randrange(64)
            points.append(q)
    points = sorted(set(points))
    signed = [int(x) for x in np.array(points, np.uint64).view(np.int64)]
    found = components(simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), hot=hot))
    roots = {r.u: r.root for r in found.collect()}
    want = brute_components(points)
    for i in range(len(points)):
        for j in range(i):
            same = roots.get(signed[i], signed[i]) == roots.get(signed[j], signed[j])
            assert same == (want[i] == want[j])


def test_simhash_rows(spark, docs):
    base = " ".join(f"w{i}" for i in range(2000))
    texts = [*ODD, base, base + " end", base.replace("w7 ", "x7 ")]
    got = {r.doc_id: r for r in simhash.simhash_components(docs(texts)).collect()}
    points = [plain_fingerprint(t) for t in texts]
    want = brute_components(points)
    assert [got[i].component_id for i in range(len(texts))] == want
    assert [int(got[i].fingerprint, 16) for i in range(len(texts))] == points
    assert simhash.simhash_components(docs([])).count() == 0
    assert near.stage(spark, docs(texts), "").count() == len(set(want))


def test_components_of_a_long_chain(spark):
    n = 60
    rows = components(spark.createDataFrame([(i, i + 1) for i in range(n)], "u long, v long")).collect()
    assert {r.root for r in rows} == {0} and len(rows) == n + 1


# packing


def whole(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_path(packing.TOKENIZER))
    return [t.encode(x or "", add_special_tokens=False).ids + [0] for x in texts]


def test_chunks_give_the_ids_of_whole_texts():
    encoder = packing.ChunkEncoder(packing.tokenizer_path(packing.TOKENIZER))
    texts = [*ODD, "it's we'll <|endoftext|> a<|startoftext|>b  ́x é 12 3.5\x1cq\x85r", "Ünïcode, pünct…!!", "don't'S 'LL", "Öffnen, GRÖSSE. straße; naïve.. e\u0301, ÷× ªº µm İ. ŸES, don't. a.b, ,. x,"]
    for text, ids in zip(texts, whole(texts)):
        got = np.frombuffer(encoder.encode((text or "").encode()), "<u4").tolist()
        assert got + [0] == ids, text


def check_packing(rows, texts, ids, capacity):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert sorted(by_doc) == list(range(len(texts)))
    for i, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.piece)
        assert sum(r.length for r in pieces) == len(ids[i])
        at = 0
        for k, r in enumerate(pieces):
            assert (r.piece, r.start) == (k, at) and 0 < r.length <= capacity
            assert r.length == capacity or k == len(pieces) - 1
            assert r.ids_crc32 == zlib.crc32(np.array(ids[i][at : at + r.length], "<u4").tobytes())
            at += r.length
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_seq)


@pytest.mark.parametrize("parts", [1, 4])
def test_packing(spark, docs, parts):
    rng = random.Random(1)
    texts = [*ODD, *(" ".join(["cat"] * rng.choice([5, 5, 5, 700, 1300, 2046, 2047, 2048])) for _ in range(80))]
    rows = packing.pack(docs(texts).repartition(parts)).collect()
    ids = whole(texts)
    used = check_packing(rows, texts, ids, 2048)
    assert used <= 1.1 * sum(map(len, ids)) / 2048 + 2
    assert packing.pack(docs([])).count() == 0


def one_by_one(lengths, capacity):
    free = []
    for x in sorted(lengths, reverse=True):
        fits = [i for i, f in enumerate(free) if f >= x]
        if fits:
            free[min(fits, key=lambda i: free[i])] -= x
        else:
            free.append(capacity - x)
    return sorted(free)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=60))
def test_plan_is_best_fit_decreasing(lengths):
    counts = {x: lengths.count(x) for x in lengths}
    fill, taken = {}, {x: [] for x in counts}
    for length, lo, hi, first, each, at in packing.plan(counts, 20):
        taken[length] += range(lo, hi)
        for r in range(lo, hi):
            seq, off = first + (r - lo) // each, at + (r - lo) % each * length
            assert fill.get(seq, 0) == off
            fill[seq] = off + length
    assert all(sorted(v) == list(range(counts[k])) for k, v in taken.items())
    assert sorted(20 - x for x in fill.values()) == one_by_one(lengths, 20)
