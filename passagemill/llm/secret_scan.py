"""Secret scan with corpus-wide ownership frequency; DataFrame functions only.

Base findings, leftmost and non-overlapping for each kind: `assign` (a keyword, a separator and a value of six characters
or more), `access` (AKIA and capitals or digits, 20 or more in all) and `hex` (24 or more of 0-9a-f). They always stay.

The method looks at candidates over the whole corpus: the values of the base findings, and `opaque` runs of 20 or more
of A-Za-z0-9_- that mix capitals, small letters and digits. A candidate's hash is counted by distinct repositories
(`source`) and distinct owners (the part of it before a slash). A candidate of more than `max_owners` owners, or of more than
`max_repositories` repositories, be they one owner's, is a widely copied example; one of few of both that has enough different
characters and no placeholder in it looks live. Opaque candidates that look live are added to the spans; candidates are counted as live or
copied, and a document is told the greatest numbers of owners and of repositories that one of its candidates has.

Shuffles hold candidates (hash, offsets), never texts. Counting goes by (hash, owner, repository), then (hash, owner),
then hash, combining before each shuffle, so a value that a third of the rows hold is a few rows for each map task.

Defined cases: null text = empty text = no finding; null source = an owner of its own; repeated rows and null ids get
a row each, but count once as an owner; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import bind, prefix_sums
from . import common

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
OPAQUE = r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}"
KINDS = ("assign", "access", "hex", "opaque")
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|your|test|xxxx|0123456|123456789|abcdef0"
MIN_VALUE, MAX_OWNERS, MAX_REPOSITORIES, MIN_DISTINCT = 6, 2, 16, 8


def spans(text: Column, pattern: str, kind: int, group: int = 0) -> Column:
    """array<(s, k, e, v)>: code-point offsets of the matches, end exclusive, and the group's text."""
    empty = F.array().cast("array<struct<s:int,k:int,e:int,v:string>>")
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    items = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(whole)).alias("gap"), F.transform(whole, lambda x: F.length(x)).alias("len"), values.alias("v"))

    def placed(xs: Column) -> Column:
        starts = prefix_sums(F.transform(xs, lambda x: x["gap"] + x["len"]))
        return F.zip_with(xs, starts, lambda x, at: F.struct((at + x["gap"]).alias("s"), F.lit(kind).alias("k"), (at + x["gap"] + x["len"]).alias("e"), x["v"].alias("v")))

    return F.when(text.rlike(pattern), bind(items, placed)).otherwise(empty)


def _candidates(text: Column) -> Column:
    assign = F.filter(spans(text, ASSIGN, 0, 2), lambda x: F.length(x["v"]) >= MIN_VALUE)
    opaque = F.filter(spans(text, OPAQUE, 3), lambda x: x["v"].rlike("[0-9]") & x["v"].rlike("[A-Z]") & x["v"].rlike("[a-z]"))
    return F.concat(assign, spans(text, ACCESS, 1), spans(text, HEX, 2), opaque)


def _render(found: Column) -> Column:
    """kind:start:end by start, then kind."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(found), lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def _owner(repository: Column) -> Column:
    return F.substring_index(repository, "/", 1)


def _live_looking(value: Column) -> Column:
    return (F.size(F.array_distinct(F.split(value, ""))) >= MIN_DISTINCT) & ~value.rlike(PLACEHOLDER)


def ownership(candidates: DataFrame) -> DataFrame:
    """(h, n_repositories, n_owners) of each candidate hash. candidates: (h, repository)."""
    owned = candidates.groupBy("h", "repository").agg(F.first(_owner(F.col("repository"))).alias("owner"))
    by_owner = owned.groupBy("h", "owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("h").agg(F.sum("n").alias("n_repositories"), F.count("*").alias("n_owners"))


def secret_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", repository_col: str = "source", max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """(id_col, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied, most_owners, most_repositories) of every row; see the module's docstring."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = F.transform(
        _candidates(text),
        lambda x: F.struct(x["s"], x["k"], x["e"], F.sha2(x["v"], 256).alias("h"), _live_looking(x["v"]).alias("live")),
    )
    rows = df.select(F.col(id_col).alias("id"), F.col(repository_col).cast("string").alias("repository"), found.alias("found"))
    # numbered as they are written, so the numbers are fixed from here on
    rows = common.materialize(rows.withColumn("row", F.monotonically_increasing_id()), "secret-candidates")
    each = rows.where(F.size("found") > 0).select("row", "repository", F.explode("found").alias("x"))
    each = each.select("row", "repository", F.col("x.s").alias("s"), F.col("x.k").alias("k"), F.col("x.e").alias("e"), F.col("x.h").alias("h"), F.col("x.live").alias("looks"))
    judged = each.join(ownership(each.select("h", "repository")).hint("merge"), "h").withColumn("copied", (F.col("n_owners") > max_owners) | (F.col("n_repositories") > max_repositories)).withColumn("live", F.col("looks") & ~F.col("copied"))
    verdicts = judged.groupBy("row").agg(
        F.collect_list(F.when(F.col("live") & (F.col("k") == 3), F.struct("s", "k", "e"))).alias("added"),
        F.count_if("live").alias("n_live"),
        F.count_if("copied").alias("n_copied"),
        F.max("n_owners").alias("most_owners"),
        F.max("n_repositories").alias("most_repositories"),
    )
    base = F.transform(F.filter("found", lambda x: x["k"] < 3), lambda x: F.struct(x["s"], x["k"], x["e"]))
    number = lambda k: F.size(F.filter("found", lambda x: x["k"] == k)).cast("long")
    nothing = F.array().cast("array<struct<s:int,k:int,e:int>>")
    return rows.join(verdicts.hint("merge"), "row", "left").select(
        F.col("id").alias(id_col),
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(_render(base), 256).alias("base_sha256"),
        _render(F.concat(base, F.coalesce("added", nothing))).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_copied", "most_owners", "most_repositories")],
    )


def op1_secret_scan(spark, sf_dir: str) -> DataFrame:
    return secret_scan(common.table(spark, sf_dir, "documents"))


def _oracle() -> str:
    """The same in DuckDB. Its regular expressions have no look-behind, which greedy runs don't need."""
    patterns = (ASSIGN, ACCESS, HEX, OPAQUE.partition(")")[2])
    quoted = ["'" + p.replace("'", "''") + "'" for p in patterns]
    found = " UNION ALL ".join(
        f"SELECT rk, source, {k} AS k, string_split_regex(text, {q}) AS gaps, regexp_extract_all(text, {q}) AS hits, regexp_extract_all(text, {q}, {2 if k == 0 else 0}) AS vals FROM d WHERE regexp_matches(text, {q})"
        for k, q in enumerate(quoted)
    )
    shown = "string_agg(list_value('assign', 'access', 'hex', 'opaque')[k + 1] || ':' || s || ':' || e, ',' ORDER BY s, k, e)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rk, doc_id, source, coalesce(text, '') AS text FROM documents),
m AS ({found}),
u AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM m),
f AS (SELECT rk, source, k, vals[i] AS v, hits[i] AS hit,
        (list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i-1], lambda x: length(x))), 0))::INT AS s FROM u),
c AS (SELECT *, (s + length(hit))::INT AS e FROM f
      WHERE CASE k WHEN 0 THEN length(v) >= {MIN_VALUE} WHEN 3 THEN regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[a-z]') ELSE true END),
o AS (SELECT v, count(DISTINCT split_part(coalesce(source, chr(1)), '/', 1)) AS owners, count(DISTINCT coalesce(source, chr(1))) AS repositories FROM c GROUP BY v),
j AS (SELECT c.*, owners, repositories, owners <= {MAX_OWNERS} AND repositories <= {MAX_REPOSITORIES} AND len(list_distinct(string_split(v, ''))) >= {MIN_DISTINCT} AND NOT regexp_matches(v, '{PLACEHOLDER}') AS live FROM c JOIN o USING (v)),
g AS (SELECT rk, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
        {shown} FILTER (k < 3) AS base, {shown} FILTER (k < 3 OR live) AS spans, count(*) FILTER (live) AS n_live, count(*) FILTER (owners > {MAX_OWNERS} OR repositories > {MAX_REPOSITORIES}) AS n_copied, max(owners) AS most_owners, max(repositories) AS most_repositories FROM j GROUP BY rk)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied, coalesce(most_owners, 0) AS most_owners, coalesce(most_repositories, 0) AS most_repositories
FROM d LEFT JOIN g USING (rk)
"""


SQL = {"op1_secret_scan": _oracle()}
