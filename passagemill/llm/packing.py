"""Best-fit packing by length-histogram planning.

Documents become token ids and an end id; those longer than a sequence are cut into whole sequences and a rest.
The plan is made over counts: the histogram of piece lengths has at most `capacity` entries whatever the corpus, and
best fit decreasing over it places ranges of equal pieces into ranges of equally filled sequences. It is what best
fit would do document by document. Pieces then take their planned slots by joining on their rank within their length.

The rank needs no task that sees all pieces of a length: each task counts within its partition, the counts
of (partition, length) are summed up along the partitions, and the two are added.

Tokenizing: text is cut at ASCII white space, which no token crosses (the tokenizer drops it), so the ids of a
text are those of its chunks in a row; each worker keeps the ids of chunks that it has seen, in bounded memory.

Defined cases: null text = empty text = one piece, the end id; null ids and repeated rows are packed as
any row; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

CAPACITY, END_ID, TOKENIZER = 2048, 0, "word_bpe_49k.json"
#: Chunks that a worker remembers, and the longest that it does, in bytes.
REMEMBERED, LONGEST = 600_000, 48
#: Chunks by which an encoder tells whether the tokenizer normalises as its short way does.
PROBES = ("Hello", "wORLD.", "Übergrößen,", "a", "Ça")
#: Slots for each length up to which a plan is broadcast.
SLOTS = 16
PIECE_SCHEMA = "piece int, start long, length long, ids_crc32 long, part int, local long"


class ChunkEncoder:
    """Token ids of UTF-8 texts as little-endian 32-bit words.

    A chunk of plain letters, with or without a full stop or comma after it, is what the tokenizer's normalizer and
    pre-tokenizer leave as one or two words, so its lower-cased words go to its BPE model at once; all others go the whole way.
    """

    #: Letters that are composed already and have one small letter each.
    PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)").fullmatch

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known: dict[bytes, bytes] = {}
        # the byte-level alphabet: printable Latin-1 characters stand for themselves, other bytes follow from 256 on
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        self.letters = dict(zip(sorted(set(range(256)) - set(shown)), range(256, 512)))
        # a tokenizer that normalises otherwise goes the whole way with every chunk
        self.direct = all(self._whole([c])[0] == self._word(c.rstrip(".,").lower()) + (self._word(c[-1]) if c[-1] in ".," else b"") for c in PROBES)

    def _word(self, word: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.letters))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _whole(self, chunks: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        return [struct.pack(f"<{len(ids := x.ids)}I", *ids) for x in found]

    def _learn(self, chunks: list[bytes], into: dict[bytes, bytes]) -> None:
        other, marks = [], {m: self._word(m) for m in ".,"} | {"": b""} if self.direct else {}
        for chunk in chunks:
            plain = self.direct and self.PLAIN(chunk.decode())
            if not plain:
                other.append(chunk)
                continue
            word, mark = plain[1].lower(), plain[2]
            ids = into.get(key := word.encode())
            if ids is None:
                ids = into[key] = self._word(word)
            into[chunk] = ids + marks[mark]
        for at in range(0, len(other), 1000):
            part = other[at : at + 1000]
            into.update(zip(part, self._whole([c.decode() for c in part])))

    def encode(self, text: bytes) -> bytes:
        chunks = text.split()
        known = self.known
        try:
            return b"".join(map(known.__getitem__, chunks))
        except KeyError:
            new = set(chunks).difference(known)
        if len(known) > REMEMBERED:
            known.clear()
            new = set(chunks)
        self._learn([c for c in new if len(c) <= LONGEST], known)
        if long := [c for c in new if len(c) > LONGEST]:
            others: dict[bytes, bytes] = {}
            self._learn(long, others)
            return b"".join([known[c] if len(c) <= LONGEST else others[c] for c in chunks])
        return b"".join(map(known.__getitem__, chunks))


@cache
def encoder(path: str) -> ChunkEncoder:
    """One for each worker process, so that what it knows outlives a task."""
    return ChunkEncoder(path)


def tokenizer_path(name_or_path: str) -> str:
    if os.path.isabs(name_or_path):
        return name_or_path
    import public_tokenizers

    return str(public_tokenizers.path(name_or_path))


def _pieces(tokenizer: str, capacity: int):
    def run(batches):
        encode, seen, part = encoder(tokenizer_path(tokenizer)).encode, defaultdict(int), TaskContext.get().partitionId()
        end, step = struct.pack("<I", END_ID), 4 * capacity
        for batch in batches:
            owner, out = [], ([], [], [], [], [])
            for row, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                ids = encode(text or b"") + end
                for piece, at in enumerate(range(0, len(ids), step)):
                    cut = ids[at : at + step]
                    owner.append(row)
                    for column, value in zip(out, (piece, at // 4, len(cut) // 4, zlib.crc32(cut), seen[len(cut) // 4])):
                        column.append(value)
                    seen[len(cut) // 4] += 1
            piece, start, length, crc, local = out
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc)), pa.array([part] * len(owner), pa.int32()), pa.array(local, pa.int64())],
                ["id", "piece", "start", "length", "ids_crc32", "part", "local"],
            )

    return run


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit decreasing over counts: (length, first rank, end rank, first sequence, pieces a sequence, offset).

    Ranks r of a length, first <= r < end, take sequence first + (r - rank) // pieces, at offset + (r - rank) % pieces * length.
    """
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # ranges (first sequence, number) by what is free in each
    free: list[int] = []  # sorted keys of room that have ranges
    opened, out = 0, []

    def put(left: int, first: int, number: int) -> None:
        if left and number:
            if not room[left]:
                insort(free, left)
            room[left].append((first, number))

    for length in sorted(counts, reverse=True):
        todo, rank = counts[length], 0
        while todo:
            at = bisect_left(free, length)
            if at < len(free):
                left = free[at]
                first, number = room[left].pop()
                if not room[left]:
                    free.pop(at)
            else:
                left, first = capacity, opened
                number = -(-todo // (capacity // length))
                opened += number
            each = left // length
            full = min(number, todo // each)
            if full:
                out.append((length, rank, rank + full * each, first, each, capacity - left))
                put(left - each * length, first, full)
                first, number, rank, todo = first + full, number - full, rank + full * each, todo - full * each
            if number and 0 < todo < each:
                out.append((length, rank, rank + todo, first, todo, capacity - left))
                put(left - todo * length, first, 1)
                first, number, rank, todo = first + 1, number - 1, rank + todo, 0
            put(left, first, number)
    return out


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """(id_col, piece, start, length, ids_crc32, sequence_id, offset) of every piece; see the module's docstring."""
    spark = df.sparkSession
    common.bound_batches(spark)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    made = rows.mapInArrow(_pieces(tokenizer, capacity), f"id {dict(rows.dtypes)['id']}, {PIECE_SCHEMA}")
    pieces = common.materialize(made, "pieces")
    counts = common.materialize(pieces.groupBy("part", "length").count(), "piece-counts")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    # at most `capacity` rows, whatever the corpus
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("count")).collect()}
    planned = plan(histogram, capacity)
    slots = spark.createDataFrame(planned, "length long, lo long, hi long, first long, each long, at long")
    ranked = pieces.join(bases.hint("merge"), ["part", "length"]).withColumn("rank", F.col("base") + F.col("local"))
    # the plan has a few rows a length, which is checked; a longer one is joined on the length
    slots = F.broadcast(slots) if len(planned) <= SLOTS * capacity else slots.hint("merge")
    placed = ranked.join(slots, (ranked["length"] == slots["length"]) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))).drop(slots["length"])
    return placed.select(
        F.col("id").alias(id_col),
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.expr("first + (rank - lo) div each").alias("sequence_id"),
        F.expr("at + (rank - lo) % each * length").alias("offset"),
    )


def op3_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their slots: the pipeline's last stage."""
    return pack(docs)
