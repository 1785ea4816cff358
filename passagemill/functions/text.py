"""Text rules of the qualification gates and the paragraph splitter, as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import bind, prefix_sums

BREAK = r"\n[ \t]*\n"
#: Number words that count as digits.
NUMBER_WORDS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve")
#: Words that say nothing about which number a role means.
GENERIC_ROLE_WORDS = ("amount", "expected", "limit", "maximum", "minimum", "number", "numeric", "required", "requirement", "rule", "stop", "threshold", "value")
REACH = 3
#: Error categories and the words that tell them, in order.
ERROR_FAMILIES = [
    ("authentication_failed", ("credential", "authentication", "api key", "401")),
    ("permission_denied", ("permission", "forbidden", "403")),
    ("rate_limited", ("rate limit", "429", "thrott")),
    ("context_limit_exceeded", ("context", "token limit", "too many tokens")),
    ("model_unavailable", ("model unavailable", "unknown model", "404")),
    ("not_configured", ("not configured", "disabled")),
    ("network_error", ("connection", "network", "timed out")),
    ("unsupported_parameter", ("unsupported parameter", "unsupported")),
]


def strip(text: Column) -> Column:
    """Without white space at both ends, Unicode's included."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def has_text(text: Column) -> Column:
    return text.rlike(r"(?U)\S")


def paragraph_spans(text: Column) -> Column:
    """array<(char_start, char_end, chunk)> of what blank lines separate, untrimmed, without chunks of white space only."""
    pieces, breaks = F.split(text, BREAK, -1), F.regexp_extract_all(text, F.lit(BREAK), F.lit(0))
    items = F.transform(F.arrays_zip(pieces.alias("piece"), breaks.alias("gap")), lambda x: F.struct(x["piece"].alias("chunk"), F.length(x["piece"]).alias("own"), F.coalesce(F.length(x["gap"]), F.lit(0)).alias("gap")))

    def placed(xs: Column) -> Column:
        starts = prefix_sums(F.transform(xs, lambda x: x["own"] + x["gap"]))
        spans = F.zip_with(xs, starts, lambda x, at: F.struct(at.alias("char_start"), (at + x["own"]).cast("int").alias("char_end"), x["chunk"].alias("chunk")))
        return F.filter(spans, lambda s: has_text(s["chunk"]))

    return bind(items, placed)


def number_words(text: Column) -> Column:
    out = F.lower(text)
    for digit, word in enumerate(NUMBER_WORDS):
        out = F.regexp_replace(out, rf"(?U)\b{word}\b", str(digit))
    return out


def normalized(text: Column) -> Column:
    """Small letters, digits and full stops, single blanks for the rest, number words as digits."""
    return F.trim(F.regexp_replace(number_words(text), "[^a-z0-9.]+", " "))


def _tokens(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda t: t != "")


def role_terms(declared: Column, role: Column) -> Column:
    """The declared terms if there are any, else the words of the role that aren't generic."""
    given = F.filter(F.transform(declared, normalized), lambda t: t != "")
    own = F.filter(_tokens(normalized(role)), lambda t: ~t.isin(*GENERIC_ROLE_WORDS))
    return F.when(declared.isNull() | (F.size(declared) == 0), own).otherwise(given)


def numeric_role_present(reference: Column, value: Column, terms: Column, unit: Column) -> Column:
    """Whether the value stands within three words of a role term and of every word of the unit (plurals are equal)."""
    bare = lambda t: F.rtrim(t, F.lit("s"))
    parts = F.struct(
        F.transform(_tokens(normalized(reference)), lambda t: F.btrim(t, F.lit("."))).alias("tokens"),
        normalized(value).alias("number"),
        F.transform(_tokens(normalized(F.coalesce(unit, F.lit("")))), bare).alias("units"),
        terms.alias("terms"),
    )

    def found(p: Column) -> Column:
        def near(t: Column, i: Column) -> Column:
            first = F.greatest(F.lit(0), i - REACH)
            window = F.slice(p["tokens"], first + 1, i + REACH + 1 - first)
            of_role = (F.size(p["terms"]) == 0) | F.arrays_overlap(p["terms"], window)
            of_unit = F.forall(p["units"], lambda u: F.exists(window, lambda w: bare(w) == u))
            return F.when(t == p["number"], of_role & of_unit).otherwise(False)

        return F.exists(F.transform(p["tokens"], near), lambda x: x)

    # bound, as the words would else be found again for each word
    return F.coalesce(bind(parts, found), F.lit(False))


def error_category(message: Column) -> Column:
    """The first family of which a word occurs."""
    low, out = F.lower(message), None
    for name, words in ERROR_FAMILIES:
        hit = F.lit(False)
        for word in words:
            hit = hit | low.contains(word)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("invalid_response")
