"""Toxicity by a weighted finite-state pattern grammar.

Words are mapped to classes: insult and threat (learned), harm, intent, target, negation and reported speech (fixed lists), and the
rest. A clause is what stands between sentence marks and line breaks. Transducers, tables of (state, symbol) -> (next state,
symbol, weight), rewrite a clause's symbols one after the other:

* AIM, NEGATION, REPORT, INTENT: for some words after a target, negation, word of reporting or intent, they mark insults, threats and harms;
* INSULT: an insult becomes a match: negated, reported, targeted or plain;
* THREAT: a threat, or a harm that is intended, becomes a match: negated, reported or a threat.

`compose` makes one machine of them, which reads a clause once; a target behind a match is marked before that by AIM running
from right to left. Arcs that write a match carry the match's weight, and a clause's score is the sum of its arcs' weights. A
learned word without any mark in its clause is a match of the kind `insult`, with a weight of its own, as the training rows tell it: where toxic words
stand anywhere, as in invented prose, an isolated one decides. A document's score is logistic in whether any clause matched and in the logarithm of its clauses' scores.

What is learned, on labelled rows whose crc32(id as text) mod 4 is not 2, at most `sample` of them (those of the smallest
hashes): the lexicon, that is words and word beginnings that stand in toxic texts in many different contexts (the words before and
after, so that copies of one text count once) and hardly in others; which of its entries are threats (most of their places in toxic texts
follow an intent); the matches' weights (log odds) and the logistic's. How much likelier an entry must be in toxic texts is
chosen among `ODDS` by cross-validation within these rows.

Defined cases: null text = empty text, scored as a text without matches; null ids are hashed as an empty text; no usable labels
= the lexicon is empty and every score is the prior; repeated rows get a row each; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
#: Rows to learn from, contexts that an entry needs, lengths of word beginnings.
SAMPLE, MIN_CONTEXTS, STEMS = 20_000, 5, (4, 5, 6, 7)
#: Odds that cross-validation chooses from, and its folds.
ODDS, PARTS = (4.0, 8.0, 16.0, 32.0, 64.0, 128.0, 256.0), 5
#: Words within which negation, report, target or intent reach a match.
REACH = 4
#: Words that a worker remembers to be of no class that matches.
REMEMBERED = 500_000

# Closed word classes in English, German, French and Spanish.
WORDS = {
    "target": ("you", "your", "you're", "yourself", "u", "ur", "he", "she", "they", "them", "him", "her", "du", "dich", "dir", "ihr", "euch", "sie", "tu", "te", "toi", "vous", "lui", "elle", "ils", "tú", "ti", "usted", "ustedes", "vosotros", "él", "ella", "ellos"),
    "negation": ("not", "never", "no", "nobody", "isn't", "aren't", "don't", "doesn't", "didn't", "cannot", "can't", "nicht", "kein", "keine", "keiner", "nie", "niemals", "pas", "jamais", "aucun", "nunca", "jamás", "tampoco"),
    "report": ("said", "says", "say", "told", "tells", "called", "calls", "quoted", "reported", "wrote", "according", "sagte", "sagt", "schrieb", "nannte", "dit", "disait", "écrit", "appelé", "dijo", "dice", "escribió", "llamó"),
    "intent": ("will", "gonna", "going", "shall", "i'll", "we'll", "werde", "wirst", "vais", "va", "voy", "vas"),
    "harm": ("kill", "hurt", "destroy", "beat", "shoot", "stab", "murder", "töten", "umbringen", "schlagen", "tuer", "frapper", "matar", "golpear"),
}
FIXED = {word: name for name, words in WORDS.items() for word in words}

CLAUSE = re.compile(r"[.!?;:\n]+")
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
CLASSES = ("insult", "threat", *WORDS, "other")
MARKABLE = ("insult", "threat", "harm")
MATCHES = ("insult", "targeted", "negated", "reported", "threat")

Symbol = tuple[str, frozenset]


# The transducers


class Transducer:
    """A complete, deterministic table: arcs[state, symbol] = (next state, symbol, weight). A weight is a match's name or nothing."""

    def __init__(self, start, arcs: dict):
        self.start, self.arcs = start, arcs

    def run(self, symbols: list[Symbol]) -> list[tuple[Symbol, str | None]]:
        state, out = self.start, []
        for x in symbols:
            state, y, weight = self.arcs[state, x]
            out.append((y, weight))
        return out

    def outputs(self) -> set[Symbol]:
        return {y for _, y, _ in self.arcs.values()}


def scope(opener: str, mark: str, symbols: set[Symbol]) -> Transducer:
    """Marks what can match within `REACH` words after an opener; the state is the number of words that are left."""
    arcs = {}
    for left in range(REACH + 1):
        for name, marks in symbols:
            told = (name, marks | {mark}) if left and name in MARKABLE else (name, marks)
            arcs[left, (name, marks)] = (REACH if name == opener else max(0, left - 1), told, None)
    return Transducer(0, arcs)


def matcher(names: tuple[str, ...], plain: str, needs: dict[str, str], aimed: bool, symbols: set[Symbol]) -> Transducer:
    """Writes a match, with its weight, for each symbol of these names; one that needs a mark and hasn't it is let through."""
    arcs = {}
    for name, marks in symbols:
        arc = (0, (name, marks), None)
        if name in names and (name not in needs or needs[name] in marks):
            kind = "negated" if "negated" in marks else "reported" if "reported" in marks else "targeted" if aimed and "aimed" in marks else plain
            arc = (0, ("match", frozenset({kind})), kind)
        arcs[0, (name, marks)] = arc
    return Transducer(0, arcs)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The transducer that does what second does with first's output."""
    start, arcs = (first.start, second.start), {}
    symbols, todo, seen = {x for _, x in first.arcs}, [start], {start}
    while todo:
        state = todo.pop()
        for x in symbols:
            one, y, a = first.arcs[state[0], x]
            two, z, b = second.arcs[state[1], y]
            arcs[state, x] = ((one, two), z, b or a)
            if (one, two) not in seen:
                seen.add((one, two))
                todo.append((one, two))
    return Transducer(start, arcs)


def _grammar() -> tuple[Transducer, Transducer]:
    """(AIM from right to left, all others composed)."""
    plain = {(c, frozenset()) for c in CLASSES}
    behind = scope("target", "aimed", plain)
    machine = scope("target", "aimed", behind.outputs())
    for opener, mark in (("negation", "negated"), ("report", "reported"), ("intent", "intended")):
        machine = compose(machine, scope(opener, mark, machine.outputs()))
    machine = compose(machine, matcher(("insult",), "insult", {}, True, machine.outputs()))
    return behind, compose(machine, matcher(("threat", "harm"), "threat", {"harm": "intended"}, False, machine.outputs()))


BEHIND, MACHINE = _grammar()
_PLAIN = {c: (c, frozenset()) for c in CLASSES}


def matches(classes: list[str]) -> Counter:
    """The matches that the machine's arcs write in one clause."""
    marked = [y for y, _ in BEHIND.run([_PLAIN[c] for c in reversed(classes)])]
    return Counter(kind for _, kind in MACHINE.run(marked[::-1]) if kind)


class Grammar:
    """The word classes, and the matches of a text."""

    def __init__(self, lexicon: dict[str, str]):
        """lexicon: entry -> insult or threat; an entry that ends in * is a word beginning."""
        self.words = {x: k for x, k in lexicon.items() if not x.endswith("*")}
        stems = {n: {x[:-1]: k for x, k in lexicon.items() if x.endswith("*") and len(x) == n + 1} for n in STEMS}
        self.stems = {n: s for n, s in stems.items() if s}
        self.plain: set[str] = set()

    def kind(self, word: str) -> str:
        if word in self.words:
            return self.words[word]
        for n, stems in self.stems.items():
            if len(word) > n and word[:n] in stems:
                return stems[word[:n]]
        return FIXED.get(word, "other")

    def __call__(self, text: str | None) -> Counter:
        text = (text or "").lower()
        new = set(WORD.findall(text)) - self.plain
        marked = {w for w in new if self.kind(w) in MARKABLE}
        if len(self.plain) > REMEMBERED:
            self.plain.clear()
        self.plain |= new - marked
        found: Counter = Counter()
        if marked:
            for clause in CLAUSE.split(text):
                words = WORD.findall(clause)
                if not marked.isdisjoint(words):
                    found += matches([self.kind(w) for w in words])
        return found


class Model:
    def __init__(self, lexicon: dict[str, str], arcs: dict[str, float], weights: list[float]):
        """arcs: the weight of a match; weights: of one, of any match, of the logarithm of the clauses' scores."""
        self.grammar, self.arcs, self.weights = Grammar(lexicon), arcs, np.array(weights)

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights @ features(self.grammar(text), self.arcs), -30, 30))))


def features(found: Counter, arcs: dict[str, float]) -> np.ndarray:
    total = sum(n * arcs.get(kind, 0.0) for kind, n in found.items())
    return np.array([1.0, float(bool(found)), np.log1p(total)])


# Learning


def _entries(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)]


def _held(text: str | None) -> set[str]:
    return {e for w in set(WORD.findall((text or "").lower())) for e in _entries(w)}


def _document_counts(batches):
    """(entry, toxic, part, n): documents of the batch that hold the entry."""
    for batch in batches:
        counts: dict[tuple[int, int], Counter] = {}
        for text, toxic, part in zip(*(batch.column(i).to_pylist() for i in range(3))):
            counts.setdefault((toxic, part), Counter()).update(_held(text))
        for (toxic, part), held in counts.items():
            columns = [pa.array(list(held), pa.string()), pa.array([toxic] * len(held), pa.int32()), pa.array([part] * len(held), pa.int32()), pa.array(list(held.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["entry", "toxic", "part", "n"])


def _contexts(entries: frozenset):
    def run(batches):
        """(entry, context, intended): the words around, for each place in toxic texts, and whether an intent is before it."""
        for batch in batches:
            out = set()
            for text in batch.column(0).to_pylist():
                words = ["", *WORD.findall((text or "").lower()), ""]
                for i in range(1, len(words) - 1):
                    able = [e for e in _entries(words[i]) if e in entries]
                    if able:
                        context = zlib.crc32(f"{words[i - 1]}\x1f{words[i + 1]}".encode())
                        intended = any(FIXED.get(w) == "intent" for w in words[max(0, i - REACH) : i])
                        out.update((e, context, intended) for e in able)
            rows = sorted(out)
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.bool_())], ["entry", "context", "intended"])

    return run


def _best_odds(odds: dict[str, list[float]]):
    def run(batches):
        """(label, best, n): the highest odds of an entry of the row, as the rows of the other parts tell them."""
        for batch in batches:
            rows = Counter()
            for text, label, part in zip(*(batch.column(i).to_pylist() for i in range(3))):
                rows[label, max((odds[e][part] for e in _held(text) if e in odds), default=0.0)] += 1
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.float64()), pa.array(list(rows.values()), pa.int64())], ["label", "best", "n"])

    return run


def _matched(lexicon: dict[str, str]):
    def run(batches):
        grammar = Grammar(lexicon)
        for batch in batches:
            rows: Counter = Counter()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = grammar(text)
                rows[(label, *(found[m] for m in MATCHES))] += 1
            yield pa.RecordBatch.from_arrays([pa.array([list(r) for r in rows], pa.list_(pa.int64())), pa.array(list(rows.values()), pa.int64())], ["row", "n"])

    return run


def logistic(rows: np.ndarray, labels: np.ndarray, n: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    """Weights by Newton's method; every match counts for toxicity or not at all."""
    held = np.ones(rows.shape[1], bool)
    while True:
        x, w = rows[:, held], np.zeros(held.sum())
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (n * (labels - p)) - ridge * w)
            w += step
            if np.abs(step).max() < 1e-9:
                break
        out = np.zeros(rows.shape[1])
        out[held] = w
        bad = (out < 0) & (np.arange(len(out)) > 0)
        if not bad.any():
            return out
        held &= ~bad


def log_odds(t: float, c: float, toxic: int, clean: int) -> float:
    return float(np.log((t + 0.5) / (toxic + 1)) - np.log((c + 0.5) / (clean + 1)))


def choose_odds(told: list[tuple[int, float, int]], odds: tuple[float, ...] = ODDS) -> float:
    """The odds at which 'some entry is that likely' tells the labels best (F1); the higher of equals. told: (label, best, n)."""

    def f1(least: float) -> float:
        hit = sum(n for label, best, n in told if label and best >= least)
        wrong = sum(n for label, best, n in told if bool(label) != (best >= least))
        return 2 * hit / max(1, 2 * hit + wrong)

    return max(odds, key=lambda o: (f1(o), o))


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> tuple[dict[str, str], dict[str, float], list[float]]:
    """(lexicon, weights of matches, weights of the logistic): what a Model takes. All that is collected is bounded by the sample."""
    common.bound_batches(df.sparkSession)
    fold = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS
    told = labels.where((fold != HELD_OUT) & F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("key"), F.col(label_col).cast("int").alias("label"))
    told = told.groupBy("key").agg(F.max("label").alias("label")).orderBy(F.xxhash64("key"), "key").limit(sample)
    told = told.withColumn("part", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(PARTS)).cast("int"))
    # at most `sample` ids and labels, so the broadcast is bounded by that parameter
    rows = df.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(told), "key").select("text", "label", "part")
    rows = common.materialize(rows, "toxicity-sample")
    totals = Counter()
    for r in rows.groupBy("label", "part").agg(F.count("*").alias("n")).collect():
        totals[r.label, r.part], totals[r.label] = r.n, totals[r.label] + r.n
    toxic, clean = totals[1], totals[0]
    if not toxic:
        prior = 0.5 / (clean + 2)  # under the threshold even without any label
        return {}, {}, [float(np.log(prior / (1 - prior))), 0.0, 0.0]
    of = lambda label, part: F.sum(F.when((F.col("toxic") == label) & (F.lit(part is None) | (F.col("part") == (part or 0))), F.col("n")).otherwise(0))
    counts = rows.mapInArrow(_document_counts, "entry string, toxic int, part int, n long").groupBy("entry").agg(
        of(1, None).alias("t"), of(0, None).alias("c"), *[of(label, p).alias(f"{name}{p}") for label, name in ((1, "t"), (0, "c")) for p in range(PARTS)]
    )
    odds = ((F.col("t") + 0.5) / (toxic + 1)) / ((F.col("c") + 0.5) / (clean + 1))
    able = {r.entry: r for r in counts.where((F.col("t") >= MIN_CONTEXTS) & (odds >= min(ODDS))).collect()}
    spread = rows.where("label = 1").select("text").mapInArrow(_contexts(frozenset(able)), "entry string, context long, intended boolean")
    # by entry and context first, so that an entry of very many contexts is counted before it is shuffled
    spread = spread.groupBy("entry", "context").agg(F.max(F.col("intended").cast("int")).alias("intended"))
    spread = spread.groupBy("entry").agg(F.count("*").alias("contexts"), F.avg("intended").alias("intended"))
    spread = {r.entry: r for r in spread.where(F.col("contexts") >= MIN_CONTEXTS).collect()}

    def without(e: str, p: int) -> float:  # the odds that the other parts tell
        t, c = able[e].t - able[e][f"t{p}"], able[e].c - able[e][f"c{p}"]
        return float(np.exp(log_odds(t, c, toxic - totals[1, p], clean - totals[0, p]))) if t >= MIN_CONTEXTS else 0.0

    others = {e: [without(e, p) for p in range(PARTS)] for e in spread}
    best = rows.mapInArrow(_best_odds(others), "label int, best double, n long").groupBy("label", "best").agg(F.sum("n").alias("n")).collect()
    least = np.log(choose_odds([tuple(r) for r in best]))
    lexicon = {e: "threat" if r.intended >= 0.5 else "insult" for e, r in sorted(spread.items()) if log_odds(able[e].t, able[e].c, toxic, clean) >= least}
    # rows of equal matches are one row
    matched = rows.select("text", "label").mapInArrow(_matched(lexicon), "row array<long>, n long").groupBy("row").agg(F.sum("n").alias("n")).collect()
    matched = sorted((r.row, r.n) for r in matched)
    held = lambda m, label: sum(n for row, n in matched if row[0] == label and row[1 + m])
    arcs = {kind: max(0.0, log_odds(held(m, 1), held(m, 0), toxic, clean)) for m, kind in enumerate(MATCHES)}
    table = np.array([features(Counter({k: x for k, x in zip(MATCHES, row[1:]) if x}), arcs) for row, _ in matched])
    weights = logistic(table, np.array([row[0] for row, _ in matched], float), np.array([n for _, n in matched], float))
    return lexicon, arcs, [float(w) for w in weights]


# Scoring


def _score(model: tuple):
    def run(batches):
        known = Model(*model)
        for batch in batches:
            scores = [known.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["key", "score"])

    return run


def scored(df: DataFrame, model: tuple, keep: list[str], text_col: str = "text") -> DataFrame:
    """(held: the columns `keep`, score) of every row."""
    common.bound_batches(df.sparkSession)
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("key"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_score(model), f"key {rows.schema['key'].dataType.simpleString()}, score double").withColumnRenamed("key", "held")


def toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id_col, held_out, score, predicted) of every row; see the module's docstring."""
    rows = scored(df, train(df, labels, id_col, text_col), [id_col], text_col).select(f"held.{id_col}", "score")
    fold = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS
    return rows.select(id_col, (fold == HELD_OUT).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold, columns as they came."""
    model = train(docs, common.table(spark, sf_dir, "labels"))
    return scored(docs, model, docs.columns).where(F.col("score") < THRESHOLD).select("held.*")
