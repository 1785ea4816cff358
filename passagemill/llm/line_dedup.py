"""Line dedup by a segment-partition edit join; DataFrame functions only.

Equal lines of any length are alike; blank ones are no lines. Lines of `min_chars` code points or more are also alike when their
edit distance is at most `edits`: in words (what single blanks separate) if a line has `words` of them, so that a changed number, date or name
is one edit however long it is; in characters if it has fewer. A class is a connected component of alike lines. Of each
class the first line in (id, position) order stays, all others are dropped.

The join: a line of n symbols is cut into edits + 1 even segments. Of two alike lines, the longer one has a segment
of the shorter one at a position that the multi-match-aware windows allow. So every line sends (n, segment number,
segment) of its own cut, and, as the longer partner, of the windows for n - edits to n; lines that share
such a key are candidates. Candidates must agree in all but one of 16 blocks counted from both ends (for one edit), and
what is left between these is verified with the banded bit-parallel edit distance.

Keys of more than `hot` different lines, as in a large group of near copies, are not paired (for one edit): their lines
send the forms with one symbol left out, and those that share a form at one place, or whose form is another line,
are alike. A form is two sums of hashes of (symbol, place), which running sums give for all places at once, so that costs
as many rows as a line has symbols, however large the group, and loses no link. (For more edits every key is paired.)

Lines travel as 128-bit digests; texts are shuffled once, to verify. Equal lines are made one before keys are made.

Defined cases: null text = no lines; an empty text is one blank line; rows of one id and one text are one document;
ties go by position; a null id comes first; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import bind
from . import common
from .components import components

EDITS, MIN_CHARS, WORDS, HOT, BLOCKS, DEALS = 1, 24, 12, 64, 16, 8


def symbols(line: Column, words: int) -> Column:
    """The line's words if it has that many, else its characters."""
    return bind(F.split(line, " "), lambda w: F.when(F.size(w) >= words, w).when(line != "", F.split(line, "")).otherwise(F.array().cast("array<string>")))


def cut(length: Column, edits: int, i: int) -> tuple[Column, Column]:
    """(start, length) of segment i of a line of that many symbols; the last segments are the longer ones."""
    n = edits + 1
    short, longer = F.floor(length / n).cast("int"), length % n
    extra = F.greatest(F.lit(0), F.lit(i) - (F.lit(n) - longer))
    return short * i + extra, short + F.when(F.lit(i) >= F.lit(n) - longer, 1).otherwise(0)


def _key(line: Column, kind: Column, length: Column, edits: int, i: int, less: int, shift: int) -> Column:
    """The hash of (kind of symbols, length, i, the symbols of `line` where a line of `less` fewer has segment i, moved by shift).

    Segments at an end are always there, and words at an end need no array of all words.
    """
    start, size = cut(length - less, edits, i)
    start = start + shift
    if i == 0 and shift == 0:
        piece = F.when(kind, F.call_function("substring_index", line, F.lit(" "), size)).otherwise(F.substring(line, F.lit(1), size))
    elif i == edits and shift == less:
        piece = F.when(kind, F.call_function("substring_index", line, F.lit(" "), -size)).otherwise(F.substring(line, start + 1, size))
    else:
        piece = F.when(kind, F.array_join(F.slice(F.split(line, " "), start + 1, size), " ")).otherwise(F.substring(line, start + 1, size))
        piece = F.when((start >= 0) & (start + size <= length), piece)
    key = F.xxhash64(kind, length - less, F.lit(i), piece)
    return key if edits == 1 else F.when((length >= less) & piece.isNotNull(), key)


def index_keys(line: Column, kind: Column, length: Column, edits: int) -> list[Column]:
    """Keys of a line's own cut."""
    return [_key(line, kind, length, edits, i, 0, 0) for i in range(edits + 1)]


def probe_keys(line: Column, kind: Column, length: Column, edits: int) -> list[Column]:
    """Those of the windows that are not index keys themselves; null where the line has no such window."""
    keys = []
    for less in range(edits + 1):
        for i in range(edits + 1):
            lo, hi = max(-i, less - (edits - i)), min(i, less + (edits - i))
            keys += [_key(line, kind, length, edits, i, less, s) for s in range(lo, hi + 1) if less or s]
    return keys


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are computed once however often later ones name them: a generator's output isn't merged into what reads it,
    and generated code stays in pieces that are small enough to be compiled."""
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.explode(F.array(made)).alias("_once")).select(*df.columns, "_once.*")


def banded_distance(a: Column, b: Column, edits: int) -> Column:
    """The edit distance of two arrays if it is at most edits, else more than that: bit-parallel in a diagonal band of 2 * edits + 1.

    Two lines of lengths that differ by more than edits are not compared. a and b should be columns that exist already, as
    the expression names them often.
    """
    k, mask = edits, (1 << 2 * edits + 1) - 1
    pad = F.array(*[F.lit("\x01")] * (edits + 1))
    x, y = F.concat(pad, a), F.concat(pad, b)
    n = F.size(a) + edits + 1

    def band(c: Column, at: Column) -> Column:  # which of a's symbols around the diagonal equal b's symbol
        same = [F.when((at + t >= 0) & (F.get(x, at + t) == c), 1 << (k + t)).otherwise(0) for t in range(-k, k + 1)]
        return sum(same[1:], same[0])

    def step(s: Column, match: Column) -> Column:
        at, vp, vn = s["i"], s["vp"], s["vn"]
        d0 = ((match.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(match).bitwiseOR(vn).bitwiseAND(F.lit(mask))
        hp = vn.bitwiseOR(d0.bitwiseOR(vp).bitwiseXOR(F.lit(mask)))
        hn = d0.bitwiseAND(vp)
        half = F.shiftright(d0, 1)
        down = at < n - k  # along the diagonal, then along the last row
        bit = F.call_function("shiftright", F.lit(1 << 2 * k), F.when(down, 0).otherwise(at - (n - k) + 1))
        has = lambda v: F.when(v.bitwiseAND(bit) != 0, 1).otherwise(0)
        cost = F.when(down, 1 - has(d0)).otherwise(has(hp) - has(hn))
        return F.struct(
            (at + 1).alias("i"),
            hn.bitwiseOR(half.bitwiseOR(hp).bitwiseXOR(F.lit(mask))).bitwiseAND(F.lit(mask)).alias("vp"),
            half.bitwiseAND(hp).alias("vn"),
            (s["d"] + cost).alias("d"),
        )

    start = F.struct(F.lit(0).alias("i"), F.lit(mask & ~((1 << k) - 1)).alias("vp"), F.lit(0).alias("vn"), F.lit(k).alias("d"))
    return F.when(F.abs(F.size(a) - F.size(b)) <= edits, F.aggregate(F.transform(y, band), start, step, lambda s: s["d"])).otherwise(edits + 1)


def with_distance(pairs: DataFrame, edits: int) -> DataFrame:
    """pairs (a, b: arrays of symbols, ..) with distance: null if the blocks already tell that it is more than edits.

    Blocks equal from either end are left out, the rest is verified. Each step is a projection of its own, so that none repeats another's expressions.
    """
    a, b, left, width, full = (F.col(c) for c in ("a", "b", "left", "width", "full"))

    def run(block) -> Column:  # how many of the first blocks are equal
        same = F.transform(F.sequence(F.lit(1), F.lit(BLOCKS)), lambda i: F.when((i <= full) & (block(a, i) == block(b, i)), 0).otherwise(1))
        at = F.array_position(same, 1)
        return F.when(at == 0, F.lit(BLOCKS)).otherwise((at - 1).cast("int"))

    short = F.least(F.size("a"), F.size("b"))
    out = pairs.withColumn("short", short).withColumn("width", F.greatest(F.lit(1), F.ceil(F.col("short") / BLOCKS).cast("int")))
    out = out.withColumn("full", F.floor(F.col("short") / width).cast("int"))  # whole blocks that both lines have
    out = out.withColumn("left", run(lambda x, i: F.slice(x, (i - 1) * width + 1, width)))
    out = out.withColumn("right", F.least(run(lambda x, i: F.slice(x, F.size(x) - i * width + 1, width)), full - left))
    out = out.withColumn("equal", (left + F.col("right")) * width)
    # one edit touches one block, two if it moves what follows, and what is no whole block
    near = (F.col("short") - F.col("equal") <= 2 * width) if edits == 1 else F.lit(True)
    rest = lambda x: F.when(near, F.slice(x, left * width + 1, F.size(x) - F.col("equal")))
    out = out.withColumns({"x": rest(a), "y": rest(b)})
    return out.withColumn("distance", banded_distance(F.col("x"), F.col("y"), edits)).select(*pairs.columns, "distance")


def _digest(x: Column) -> Column:
    return F.unhex(F.md5(x))


def document_key(id_col: str, text_col: str) -> Column:
    return _digest(F.concat_ws("\x1f", F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.col(text_col).cast("string")))


def _exploded(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = df.select(document_key(id_col, text_col).alias("doc"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.select("doc", "id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))


def _lines(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return _exploded(df, id_col, text_col).where(F.col("line").rlike(r"\S"))


def left_out(lines: DataFrame) -> DataFrame:
    """(num, kind, n, place, one, two): two sums for each line (num, kind, line: array of symbols) with each of its symbols left out; and as place -1 of the whole line.

    Sums that run over a line's symbols, which are rows: what is before a place stays where it is, what is behind it moves by one. Lines are dealt
    over all tasks by their number, which Spark doesn't put together again however small they are before they are spread out.
    """
    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = lines.repartition(tasks, "num").select("num", "kind", F.size("line").alias("n"), F.posexplode("line").alias("place", "x"))
    salts = (("one", 1), ("two", 2))
    value = lambda salt, moved: F.pmod(F.xxhash64("x", F.col("place") - moved, F.lit(salt)), F.lit(1 << 40))
    each = each.select("num", "kind", "n", "place", *[value(salt, moved).alias(f"{end}_{name}") for name, salt in salts for end, moved in (("here", 0), ("moved", 1))])
    line = Window.partitionBy("num").orderBy("place")
    before, behind = line.rowsBetween(Window.unboundedPreceding, -1), line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every, none = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing), F.lit(0).cast("long")
    sums = [(F.coalesce(F.sum(f"here_{name}").over(before), none) + F.sum(f"moved_{name}").over(every) - F.sum(f"moved_{name}").over(behind)).alias(name) for name, _ in salts]
    ran = each.select("num", "kind", "n", "place", *sums, *[F.sum(f"here_{name}").over(behind).alias(f"all_{name}") for name, _ in salts])
    form, whole = F.struct("place", "one", "two"), F.struct(F.lit(-1).alias("place"), F.col("all_one").alias("one"), F.col("all_two").alias("two"))
    both = F.when(F.col("place") == F.col("n") - 1, F.array(form, whole)).otherwise(F.array(form))
    return ran.select("num", "kind", "n", F.explode(both).alias("x")).select("num", "kind", "n", "x.*")


def line_links(keyed: DataFrame, texts, edits: int, hot: int, words: int) -> tuple[DataFrame, list[DataFrame]]:
    """((u, v) digests of alike lines, enough to connect all that are; the tables that they are read from). keyed: distinct lines' (d, key, indexed); texts(digests) -> (d, line)."""
    sizes = common.materialize(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "line-key-sizes")
    paired = sizes if edits > 1 else sizes.where(F.col("n") <= hot)
    near = common.materialize(keyed.join(paired.select("key").hint("merge"), "key"), "line-keys")
    left = near.where("indexed").select("key", F.col("d").alias("u"))
    right = near.select("key", F.col("d").alias("v"), "indexed")
    pairs = left.join(right.hint("merge"), "key").where(F.when(F.col("indexed"), F.col("u") < F.col("v")).otherwise(F.col("u") != F.col("v")))
    pairs = common.materialize(pairs.select("u", "v").distinct(), "line-candidates")
    crowded = keyed.join(sizes.join(paired.hint("merge"), "key", "left_anti").select("key").hint("merge"), "key").select("d").distinct()
    crowded = common.materialize(crowded, "crowded-lines")
    needed = pairs.select(F.col("u").alias("d")).unionByName(pairs.select(F.col("v").alias("d"))).unionByName(crowded).distinct()
    known = texts(needed).select("d", (F.size(F.split("line", " ")) >= words).alias("kind"), symbols(F.col("line"), words).alias("line"))
    # numbered as they are written: numbers are merged faster than digests
    known = common.materialize(known.withColumn("num", F.monotonically_increasing_id()), "candidate-lines")
    both = pairs.join(known.select(F.col("d").alias("u"), F.col("line").alias("a")).hint("merge"), "u")
    both = both.join(known.select(F.col("d").alias("v"), F.col("line").alias("b")).hint("merge"), "v")
    # written before they are filtered: a filter would be pushed below the steps and repeat them
    told = common.materialize(with_distance(both, edits).select("u", "v", "distance"), "line-distances")
    found = told.where(F.col("distance") <= edits).select("u", "v")
    for done in (sizes, near):
        common.discard(done)
    used = [pairs, crowded, known, told]
    if edits > 1:
        return found, used
    held = known.join(crowded.hint("merge"), "d", "left_semi")
    forms = common.materialize(left_out(held), "line-forms")
    short, whole, form = forms.where("place >= 0"), forms.where("place < 0"), ["kind", "one", "two"]
    # the same place left out of both: one symbol is another
    other = short.groupBy(*form, "n", "place").agg(F.min("num").alias("u"), F.max("num").alias("most")).where("u <> most").select(*form, "n", "place", "u")
    swapped = short.join(other.hint("merge"), [*form, "n", "place"]).where("u <> num").select("u", F.col("num").alias("v"))
    # left out of one, it is the other
    shorter = whole.select(*form, (F.col("n") + 1).alias("n"), F.col("num").alias("u"))
    inserted = short.join(shorter.hint("merge"), [*form, "n"]).select("u", F.col("num").alias("v"))
    named = lambda df, c: df.join(held.select(F.col("num").alias(c), F.col("d").alias(f"{c}_d")).hint("merge"), c).drop(c).withColumnRenamed(f"{c}_d", c)
    swapped, inserted = (named(named(df, "u"), "v").select("u", "v") for df in (swapped, inserted))
    return found.unionByName(swapped).unionByName(inserted), [*used, forms]


def dropped_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS, hot: int = HOT, words: int = WORDS) -> DataFrame:
    """(doc, dropped: the positions of dropped lines, n_near: how many of them have no equal line that stays) of documents that have any."""
    line, c = F.col("line"), F.col("chars")
    lines = once(_lines(df, id_col, text_col), count=F.size(F.split(line, " ")), chars=F.length(line))
    lines = once(lines, kind=F.col("count") >= words, n=F.when(F.col("count") >= words, F.col("count")).otherwise(c))
    keys = [F.when(c >= min_chars, F.array(*f(line, F.col("kind"), F.col("n"), edits))).alias(name) for f, name in ((index_keys, "own"), (probe_keys, "probes"))]
    lines = common.materialize(lines.select("doc", "id", "pos", _digest(line).alias("d"), *keys), "lines")
    place = F.struct("id", "pos", "doc")
    distinct = lines.groupBy("d").agg(F.min(place).alias("first"), F.count("*").alias("n"), F.any_value("own").alias("own"), F.any_value("probes").alias("probes"))
    distinct = common.materialize(distinct, "distinct-lines")

    def texts(digests: DataFrame) -> DataFrame:
        every = _lines(df, id_col, text_col).where(F.length("line") >= min_chars).select(_digest(F.col("line")).alias("d"), F.pmod(F.xxhash64("doc"), F.lit(DEALS)).alias("deal"), "line")
        # dealt, so that a line of very many documents is several tasks' work; hashed, as sorting all lines would cost more than the join
        wanted = digests.select("d", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(DEALS - 1).cast("bigint"))).alias("deal"))
        return every.join(wanted.hint("shuffle_hash"), ["d", "deal"], "left_semi").groupBy("d").agg(F.first("line").alias("line"))

    keyed = [distinct.select("d", F.explode(c).alias("key")).where("key is not null").withColumn("indexed", F.lit(c == "own")) for c in ("own", "probes")]
    links, used = line_links(keyed[0].unionByName(keyed[1]), texts, edits, hot, words)
    roots = components(links).select(F.col("u").alias("d"), "root")
    for done in used:  # the components are tables of their own
        common.discard(done)
    classes = distinct.select("d", "first", "n").join(roots.hint("merge"), "d", "left")
    classes = classes.where("n > 1 or root is not null").withColumn("root", F.coalesce("root", "d"))
    firsts = classes.groupBy("root").agg(F.min("first").alias("stays"))
    classes = common.skew_join(classes, firsts, ["root"]).select("d", "stays", (F.col("first") != F.col("stays")).alias("near"))
    # rows of a few bytes; AQE splits a line that very many documents hold
    again = lines.select("doc", "id", "pos", "d").join(classes.hint("merge"), "d").where(place != F.col("stays"))
    return again.groupBy("doc").agg(F.sort_array(F.collect_set("pos")).alias("dropped"), F.count_distinct(F.when(F.col("near"), F.col("pos"))).alias("n_near"))


def line_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id_col, n_lines, n_dropped, n_near, dropped: positions from 0, comma-joined) of every row."""
    drops = dropped_lines(df, id_col, text_col, **options)
    text = F.col(text_col).cast("string")
    rows = df.select(F.col(id_col).alias("id"), document_key(id_col, text_col).alias("doc"), F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n", -1))).cast("long").alias("n_lines"))
    return rows.join(drops.hint("merge"), "doc", "left").select(
        F.col("id").alias(id_col),
        "n_lines",
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.coalesce(F.array_join("dropped", ","), F.lit("")).alias("dropped"),
    )


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """df with its texts' dropped lines left out; columns as they came."""
    drops = dropped_lines(df, id_col, text_col, **options)
    kept = df.columns
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("held"), document_key(id_col, text_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    rows = rows.join(drops.hint("merge"), "doc", "left")
    # a difference of sets: a test of each line against all that are dropped would cost their product
    kept_lines = lambda lines: F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("dropped")), lambda i: F.get(lines, i))
    text = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.array_join(bind(F.split("text", "\n", -1), kept_lines), "\n"))
    return rows.select(*[text.alias(c) if c == text_col else F.col(f"held.`{c}`").alias(c) for c in kept])


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    return line_report(common.table(spark, sf_dir, "documents"))


def _oracle() -> str:
    """The same in DuckDB, for the production parameters: alike lines share what is left of them without one symbol."""
    return f"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS rk, doc_id, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT rk, doc_id, i - 1 AS pos, ls[i] AS line FROM (SELECT *, unnest(range(1, length(ls) + 1)) AS i FROM docs) WHERE regexp_matches(ls[i], '[^ \\t\\n\\x0b\\f\\r]')),
distinct_lines AS (SELECT line, row_number() OVER (ORDER BY min(struct_pack(a := coalesce(doc_id, -1), b := pos))) AS d, min(struct_pack(a := coalesce(doc_id, -1), b := pos, c := rk)) AS first, count(*) AS n FROM lines GROUP BY line),
able AS (SELECT d, length(string_split(line, ' ')) >= {WORDS} AS kind, CASE WHEN length(string_split(line, ' ')) >= {WORDS} THEN string_split(line, ' ') ELSE string_split(line, '') END AS s FROM distinct_lines WHERE length(line) >= {MIN_CHARS}),
forms AS (SELECT d, kind, length(s) AS n, j, array_to_string(s[1:j - 1] || s[j + 1:], chr(1)) AS form FROM (SELECT *, unnest(range(1, length(s) + 1)) AS j FROM able)),
whole AS (SELECT d, kind, length(s) AS n, array_to_string(s, chr(1)) AS form FROM able),
hubs AS (SELECT kind, n, j, form, min(d) AS u FROM forms GROUP BY ALL HAVING count(*) > 1),
links AS (SELECT DISTINCT u, d AS v FROM forms JOIN hubs USING (kind, n, j, form) WHERE u <> d UNION SELECT whole.d, forms.d FROM forms JOIN whole ON forms.kind = whole.kind AND forms.n = whole.n + 1 AND forms.form = whole.form),
both_ways AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach AS (SELECT u, u AS r FROM both_ways UNION SELECT b.v, reach.r FROM reach JOIN both_ways b ON b.u = reach.u),
roots AS (SELECT u AS d, min(r) AS root FROM reach GROUP BY u),
classes AS (SELECT line, first, min(first) OVER (PARTITION BY coalesce(root, d)) AS stays FROM distinct_lines LEFT JOIN roots USING (d)),
gone AS (SELECT rk, count(*) AS n_dropped, count(*) FILTER (first <> stays) AS n_near, string_agg(pos::VARCHAR, ',' ORDER BY pos) AS dropped
         FROM lines JOIN classes USING (line) WHERE struct_pack(a := coalesce(doc_id, -1), b := pos, c := rk) <> stays GROUP BY rk)
SELECT doc_id, coalesce(length(ls), 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, coalesce(n_near, 0) AS n_near, coalesce(dropped, '') AS dropped FROM docs LEFT JOIN gone USING (rk)
"""


SQL = {"op6_line_dedup": _oracle()}


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, without their dropped lines; n_chars follows the text."""
    return line_dedup(docs).withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(docs.columns)
