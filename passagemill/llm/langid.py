"""Language ID by rank-order profiles.

A text is lower-cased and its letters (Unicode category L) are read as words between single blanks; its n-grams of one to
three characters, blanks included, are ranked by their number (ties: by code points). A language's profile is the same ranking
over all training documents of that language. A document's distance to a profile is the sum, over the document's `top`
most frequent n-grams, of how far out of place each is in the profile, at most `top` each; the nearest language is
predicted (ties: the first by name). The score is how much nearer it is than the next: 1 - distance / next distance, so 0 to 1;
with one language, 1 - distance / largest distance.

Training: documents whose crc32(id as text) mod 5 is not 0, with a language, in one pass that combines counts in each task
before the shuffle; a profile has `top` entries, so what is collected is `top` rows a language, bounded by MAX_LANGUAGES.
N-grams are counted as packed code points, exactly, with no hashing; whole texts are read, in chunks.

Defined cases: null text or no letters = und with score 0; null ids are hashed as an empty text; no training rows = und for
all; repeated rows get a row each; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

TOP, SIZES, FOLDS, UNKNOWN = 400, 3, 5, "und"
MAX_LANGUAGES = 1000
#: Characters of a text that are read at once.
CHUNK = 1 << 20


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


_TABLE: list[np.ndarray] = []


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, numbers); an n-gram is its code points, 21 bits each. Read in chunks, so that arrays are of bounded length."""
    if not _TABLE:
        _TABLE.append(_letters())
    text = " " + text.lower() + " "
    carry, after_letter, known = np.empty(0, np.int64), True, []
    for at in range(0, len(text), CHUNK):
        codes = np.frombuffer(text[at : at + CHUNK].encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
        letter = _TABLE[0][codes]
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # one blank after each word
        keep[0] |= after_letter  # and one before the first
        after_letter = bool(letter[-1])
        new = np.where(letter, codes, 32)[keep]
        joined, k = np.concatenate([carry, new]), len(carry)
        two = joined[:-1] << 21 | joined[1:]
        three = two[:-1] << 21 | joined[2:]
        known.append(np.unique(np.concatenate([new[new != 32], two[max(0, k - 1) :], three[max(0, k - 2) :]]), return_counts=True))
        carry = joined[-2:]
        if len(known) > 8:
            known = [_merged(known)]
    values, counts = _merged(known) if len(known) > 1 else known[0]
    return values, counts


def _merged(known: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    values, where = np.unique(np.concatenate([v for v, _ in known]), return_inverse=True)
    return values, np.bincount(where, np.concatenate([n for _, n in known]), len(values)).astype(np.int64)


def ranked(values: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The most frequent n-grams, in order."""
    if len(values) > top:
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        keep = counts >= least
        values, counts = values[keep], counts[keep]
    return values[np.lexsort((values, -counts))][:top]


class Profiles:
    """Ranked n-grams of each language."""

    def __init__(self, ranking: dict[str, list[int]], top: int):
        self.top, self.names, self.sorted = top, sorted(ranking), []
        for name in self.names:
            values = np.array(ranking[name], np.int64)
            order = np.argsort(values)
            self.sorted.append((values[order], order))

    def predict(self, text: str | None) -> tuple[str, float]:
        values, counts = grams(text or "")
        if not len(values) or not self.names:
            return UNKNOWN, 0.0
        mine = ranked(values, counts, self.top)
        rank, far = np.arange(len(mine)), []
        for known, place in self.sorted:
            at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
            far.append(int(np.where(known[at] == mine, np.minimum(np.abs(place[at] - rank), self.top), self.top).sum()))
        best = int(np.argmin(far))
        rest = sorted(far)[1] if len(far) > 1 else len(mine) * self.top
        return self.names[best], float(1 - far[best] / rest) if rest else 0.0


def held_out(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS == 0


def _counts(batches):
    """(lang, gram, n): merged within each batch."""
    for batch in batches:
        texts = {}
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            texts.setdefault(lang, []).append(text)
        for lang, all_texts in texts.items():
            found = [g for g in map(grams, all_texts) if len(g[0])]
            if found:
                values, total = _merged(found)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(values)), pa.array(values), pa.array(total)], ["lang", "gram", "n"])


def profiles(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", top: int = TOP) -> dict[str, list[int]]:
    """language -> its `top` most frequent n-grams, in order."""
    common.bound_batches(df.sparkSession)
    fold = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS
    rows = df.where((fold != 0) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col).cast("string"), F.col(lang_col).cast("string"))
    counts = rows.mapInArrow(_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    rows = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).limit(top * MAX_LANGUAGES + 1).collect()
    if len(rows) > top * MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: is {lang_col} a language?")
    found: dict[str, list[int]] = {}
    for row in sorted(rows, key=lambda r: r.rank):
        found.setdefault(row.lang, []).append(row.gram)
    return found


def _predict(ranking: dict[str, list[int]], top: int):
    def run(batches):
        model = Profiles(ranking, top)
        for batch in batches:
            told = [model.predict(t) for t in batch.column(1).to_pylist()]
            folds = [held_out(i) for i in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(folds, pa.bool_()), pa.array([x[0] for x in told], pa.string()), pa.array([x[1] for x in told], pa.float64())],
                ["id", "held_out", "lang_pred", "score"],
            )

    return run


def language_id(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", top: int = TOP) -> DataFrame:
    """(id_col, held_out, lang_pred, score) of every row; see the module's docstring."""
    ranking = profiles(df, id_col, text_col, lang_col, top)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    told = rows.mapInArrow(_predict(ranking, top), f"id {dict(rows.dtypes)['id']}, held_out boolean, lang_pred string, score double")
    return told.select(F.col("id").alias(id_col), "held_out", "lang_pred", "score")


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    return language_id(common.table(spark, sf_dir, "documents"))


def _oracle() -> str:
    """The same in DuckDB, which has no CRC-32: it is folded over the id's bytes, bit by bit."""
    crc = "list_reduce(list_transform(range(1, length(s) + 1), lambda i: ascii(substr(s, i, 1))::BIGINT), lambda c, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, xor(c, b)), 4294967295::BIGINT)"
    order = "ORDER BY n DESC, length(gram), gram"
    return f"""
WITH t AS (SELECT row_number() OVER () AS rk, doc_id, lang, coalesce(doc_id::VARCHAR, '') AS s, trim(regexp_replace(lower(coalesce(text, '')), '[^\\pL]+', ' ', 'g')) AS words FROM documents),
d AS (SELECT rk, doc_id, lang, xor({crc}, 4294967295) % {FOLDS} AS fold, ' ' || words || ' ' AS w FROM t),
each AS (SELECT rk, w, k, unnest(range(1, length(w) - k + 2)) AS i FROM d, range(1, {SIZES + 1}) r(k) WHERE w <> '  '),
g AS (SELECT rk, substr(w, i, k) AS gram, count(*) AS n FROM each WHERE substr(w, i, k) <> ' ' GROUP BY ALL),
told AS (SELECT lang, gram, sum(n) AS n FROM g JOIN d USING (rk) WHERE fold <> 0 AND lang IS NOT NULL GROUP BY ALL),
known AS (SELECT lang, gram, row_number() OVER (PARTITION BY lang {order}) - 1 AS place FROM told QUALIFY place < {TOP}),
mine AS (SELECT rk, gram, row_number() OVER (PARTITION BY rk {order}) - 1 AS rank FROM g QUALIFY rank < {TOP}),
far AS (SELECT rk, l.lang, sum(CASE WHEN place IS NULL THEN {TOP} ELSE least(abs(place - rank), {TOP}) END) AS far, count(*) * {TOP} AS most
        FROM mine CROSS JOIN (SELECT DISTINCT lang FROM known) l LEFT JOIN known ON known.lang = l.lang AND known.gram = mine.gram GROUP BY rk, l.lang),
near AS (SELECT rk, lang, far, coalesce(lead(far) OVER x, most) AS rest, row_number() OVER x AS nth FROM far WINDOW x AS (PARTITION BY rk ORDER BY far, lang))
SELECT doc_id, fold = 0 AS held_out, coalesce(near.lang, '{UNKNOWN}') AS lang_pred, CASE WHEN coalesce(rest, 0) > 0 THEN 1 - far / rest ELSE 0 END::DOUBLE AS score
FROM d LEFT JOIN near ON near.rk = d.rk AND nth = 1
"""


SQL = {"op7_language_id": _oracle()}
