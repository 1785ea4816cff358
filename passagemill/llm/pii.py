"""PII surrogates: detected entities get keyed, type-consistent replacements; DataFrame functions only.

Entities: email addresses, card numbers (13 to 19 digits, with single blanks or hyphens between them), phone numbers,
IPv4 addresses and the names that follow a form of address, which tells the gender. An entity is one unit, a name is one for each
of its parts, so that "Mr John Smith" and "Mr Smith" share the surrogate of Smith. A unit's canonical form leaves out case and
separators, so spellings of one entity are one unit (coreference); a phone with a country code has a "+" there, also if it is written with "00".

A name's parts are replaced wherever they stand in the same document, also without a form of address: the parts that a text's titled names have are looked
for as whole words, spelled as they were, in a second match of that text alone. Where titled names give a part two genders, the first one counts.
A name that nowhere in its document follows a form of address isn't found.

A unit's surrogate is a function of (key, type, canonical form, attempt), never of the spelling, which only tells
where separators go: digits give digits, letters give letters of the same case; a phone's country code (by the calling codes' rule)
stays; a card's first digit and whether its check digit is right stay; an address's octets stay octets; a mailbox moves to
a reserved domain of the same top level; a part of a name becomes syllables of its script with the ending of its gender.

Distinctness: the distinct units of the corpus are given surrogates together; where two would share one, or one
would equal a unit that occurs, all but one try again with the next attempt, until no clash is left. Late attempts are longer
by a character, so a crowded format has room. Only units that needed another attempt are joined to their occurrences; all
other surrogates are computed where they occur. Units are made distinct before any shuffle, so one that a third of all rows
hold is a few rows for each map task. Texts are matched once and written in pieces; they are shuffled only if there are
clashes.

The key: `key`, else the session's `spark.passagemill.pii.key`, else a random one that is drawn once for a session, so that
surrogates then agree within it only.

Defined cases: null text stays null without entities; repeated rows get a row each; an empty table gives an empty
table; other columns are ignored, and kept by `redact`, whatever their names; a domain of more than 127 labels in which no top level stands within
these is no address, of another one the first labels up to such a level are.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import bind, prefix_sums
from . import common

KEY = "spark.passagemill.pii.key"
#: The key of the query over the driver's tables, if the session has none. Data that matter need a secret one.
QUERY_KEY = "the query's own key, which everyone may know"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]{1,63}+){0,126}\.[A-Za-z]{2,24}"
CARD = r"(?<![0-9A-Za-z.+-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])"
ADDRESS = r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9]|\.[0-9])"
PHONE = r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)[ .-]?)?[0-9]{2,5}(?:[ .-]?[0-9]{2,5}){1,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9A-Za-z])"
#: Forms of address: men's, then women's.
MEN = "Mr|Herr|Monsieur|Señor|Г-н|Господин|Κύριος"
WOMEN = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Г-жа|Госпожа|Κυρία"
TITLE = rf"^(?:{MEN}|{WOMEN})\.?\x20"
NAME = rf"(?<![\p{{L}}])(?:{MEN}|{WOMEN})\.?\x20\p{{Lu}}\p{{Ll}}+(?:[ -]\p{{Lu}}\p{{Ll}}+){{0,4}}"
#: A phone whose country code follows two zeros.
ABROAD = r"(?<![0-9A-Za-z+.-])00[1-9][0-9]{0,2}[ .-]?(?:\([0-9]{2,4}\)[ .-]?)?[0-9]{2,5}(?:[ .-]?[0-9]{2,5}){1,4}(?![0-9A-Za-z])"
ENTITY = "|".join((EMAIL, ADDRESS, ABROAD, CARD, PHONE, NAME))
#: What parts the pattern of a text's own names is made of: a whole word, and more of them behind.
WORD_BEGINS, WORD_ENDS = r"(?<![\p{L}\p{M}])", r"(?![\p{L}\p{M}])"
#: A text without any of these has no entity.
SIGN = rf"[@0-9]|{MEN}|{WOMEN}"
#: Country calling codes: zones 1 and 7 have one digit, these starts two, all others three.
TWO_DIGITS = "^(?:2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"

#: Syllables of invented names by script, and endings by gender (men's, women's).
SYLLABLES = {
    "latin": ("ba", "be", "bo", "da", "de", "do", "fa", "fi", "ga", "go", "ka", "ke", "la", "le", "li", "lo", "ma", "me", "mi", "mo", "na", "ne", "no", "pa", "po", "ra", "re", "ri", "ro", "sa", "se", "ta", "te", "va", "vi", "za"),
    "cyrillic": ("ба", "бе", "бо", "ва", "ве", "го", "да", "де", "до", "за", "зе", "ка", "ко", "ла", "ле", "ли", "ло", "ма", "ме", "ми", "на", "не", "но", "па", "ра", "ре", "ри", "ро", "са", "се", "та", "те", "то"),
    "greek": ("βα", "βε", "γα", "γι", "δα", "δε", "ζα", "θε", "κα", "κο", "λα", "λε", "λι", "μα", "με", "μι", "να", "νε", "νι", "πα", "πο", "ρα", "ρε", "ρι", "σα", "σε", "τα", "τε", "φα", "φι", "χα"),
}
ENDINGS = {"latin": ("n", "na"), "cyrillic": ("н", "на"), "greek": ("ν", "να")}
#: The attempt from which on surrogates are longer, by one character for each attempt.
ROOM = 6
UNIT = "struct<kind:string,form:string>"


def session_key(spark: SparkSession) -> str:
    """The configured key; without one, a random one is drawn and kept for the session."""
    if not spark.conf.get(KEY, None):
        spark.conf.set(KEY, secrets.token_hex(32))
    return spark.conf.get(KEY)


def entity_type(raw: Column) -> Column:
    anchored = lambda p: raw.rlike(f"^(?:{p})$")
    return (
        F.when(raw.contains("@"), "email")
        .when(anchored(ADDRESS), "address")
        .when(raw.rlike(r"^\p{L}"), "name")
        .when(anchored(ABROAD), "phone")
        .when(anchored(CARD), "card")
        .otherwise("phone")
    )


def name_parts(raw: Column) -> Column:
    """The parts of a name, each with the separator behind it."""
    return F.split(F.regexp_replace(raw, TITLE, ""), "(?<=[ -])")


PART = "array<struct<part:string,gender:string>>"


def _gender(raw: Column) -> Column:
    """By the form of address; null without one."""
    return F.when(raw.rlike(f"^(?:{MEN})\\.?\\x20"), "m ").when(raw.rlike(TITLE), "f ")


def titled_parts(raws: Column) -> Column:
    """array<(part, gender)>: the parts of a text's titled names, in their order."""
    names = F.filter(raws, lambda r: r.rlike(TITLE))
    bare = lambda p: F.regexp_replace(p, "[ -]$", "")
    return F.array_distinct(F.flatten(F.transform(names, lambda r: F.transform(name_parts(r), lambda p: F.struct(bare(p).alias("part"), _gender(r).alias("gender"))))))


def own_names(names: Column) -> Column:
    """The pattern of a text that has names: all entities, and its names' parts in a row without a form of address. Parts are letters only."""
    parts = F.array_join(F.array_distinct(F.transform(names, lambda n: n["part"])), "|")
    return F.concat(F.lit(f"{ENTITY}|{WORD_BEGINS}(?:"), parts, F.lit(")(?:[ -](?:"), parts, F.lit(f"))*{WORD_ENDS}"))


def units(kind: Column, raw: Column, names: Column) -> Column:
    """array<(kind, form)>: what the spellings of an entity have in common. names: the titled parts of its text."""
    digits = F.regexp_replace(raw, "[^0-9]", "")
    abroad = raw.startswith("00") & (kind == "phone")
    number = F.when(abroad, F.concat(F.lit("+"), F.substring(digits, 3, 1 << 30))).otherwise(F.concat(F.when((kind == "phone") & raw.startswith("+"), "+").otherwise(""), digits))
    form = F.when(kind == "email", F.lower(raw)).when(kind == "address", raw).otherwise(number)

    def part(p: Column) -> Column:
        bare = F.regexp_replace(p, "[ -]$", "")
        known = F.get(F.filter(names, lambda n: n["part"] == bare), F.lit(0))["gender"]
        return F.struct(kind.alias("kind"), F.concat(F.coalesce(_gender(raw), known, F.lit("f ")), F.lower(bare)).alias("form"))

    return F.when(kind == "name", F.transform(name_parts(raw), part)).otherwise(F.array(F.struct(kind.alias("kind"), form.alias("form"))))


def _stream(kind: Column, form: Column, attempt: Column, key: str) -> Column:
    """128 hex digits, keyed."""
    return F.sha2(F.concat_ws("\x1f", F.lit(key), kind, form, attempt.cast("string"), F.lit(key)), 512)


def _number(stream: Column, at: Column | int, digits: int = 2) -> Column:
    """A number of some hex digits of the stream, which is read in a ring."""
    place = (F.lit(at) if isinstance(at, int) else at) * digits % 128
    return F.conv(F.substring(F.concat(stream, stream), place + 1, digits), 16, 10).cast("int")


def _more(attempt: Column) -> Column:
    """The numbers of the characters that a late attempt adds."""
    return F.when(attempt >= ROOM, F.sequence(F.lit(0), attempt - ROOM)).otherwise(F.array().cast("array<int>"))


def _alike(raw: Column, stream: Column, keep: Column | int = 0) -> Column:
    """A digit for each digit, a letter of the same case for each Latin letter; the first `keep` characters and all others stay."""

    def one(c: Column, i: Column) -> Column:
        n = _number(stream, i)
        return (
            F.when(i < keep, c)
            .when(c.rlike("^[0-9]$"), (n % 10).cast("string"))
            .when(c.rlike("^[a-z]$"), F.char(97 + n % 26))
            .when(c.rlike("^[A-Z]$"), F.char(65 + n % 26))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(raw, ""), one), "")


def _checksum(digits: Column) -> Column:
    """Luhn's sum modulo 10, of a string of digits."""

    def add(total: Column, d: Column) -> Column:
        twice = F.when(total["odd"], d * 2).otherwise(d)
        return F.struct((total["sum"] + F.when(twice > 9, twice - 9).otherwise(twice)).alias("sum"), (~total["odd"]).alias("odd"))

    each = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))
    return F.aggregate(each, F.struct(F.lit(0).alias("sum"), F.lit(False).alias("odd")), add, lambda t: t["sum"] % 10)


def _card(digits: Column, stream: Column) -> Column:
    made = _alike(digits, stream, 1)
    body = F.substring(made, F.lit(1), F.length(made) - 1)
    right = (10 - _checksum(F.concat(body, F.lit("0")))) % 10
    wrong = (right + 1 + _number(stream, 63) % 9) % 10
    return F.concat(body, F.when(_checksum(digits) == 0, right).otherwise(wrong).cast("string"))


def _address(stream: Column) -> Column:
    first = _number(stream, 0, 4) % 222 + 1
    return F.concat_ws(".", first.cast("string"), *[(_number(stream, i)).cast("string") for i in (2, 3, 4)])


def _phone(form: Column, stream: Column, attempt: Column) -> Column:
    digits = F.substring(form, 2, 1 << 30)
    code = F.when(digits.rlike("^[17]"), 1).when(digits.rlike(TWO_DIGITS), 2).otherwise(3)
    more = F.array_join(F.transform(_more(attempt), lambda i: (_number(stream, 40 + i) % 10).cast("string")), "")
    return F.concat(_alike(form, stream, F.when(form.startswith("+"), code + 1).otherwise(0)), more)


def _email(form: Column, stream: Column, attempt: Column, key: str) -> Column:
    top = F.regexp_extract(form, r"\.([a-z]+)$", 1)
    domain = F.regexp_extract(form, r"@(.*)$", 1)
    host = F.substring(F.sha2(F.concat_ws("\x1f", F.lit(key), domain), 256), 1, 10)
    more = F.array_join(F.transform(_more(attempt), lambda i: F.char(97 + _number(stream, 40 + i) % 26)), "")
    return F.concat(_alike(F.regexp_extract(form, "^(.*)@", 1), stream), more, F.lit("@h"), host, F.lit(".example."), F.when(top.isin("com", "net", "org"), top).otherwise("org"))


def _name(form: Column, stream: Column, attempt: Column) -> Column:
    """The syllables of one part of a name, as it is written within a text."""
    man = form.startswith("m ")

    def in_script(script: str) -> Column:
        table = F.array(*map(F.lit, SYLLABLES[script]))
        made = F.transform(F.sequence(F.lit(0), F.size(_more(attempt)) + 3), lambda k: F.element_at(table, _number(stream, k, 4) % len(SYLLABLES[script]) + 1))
        return F.initcap(F.concat(F.array_join(made, ""), F.when(man, ENDINGS[script][0]).otherwise(ENDINGS[script][1])))

    return F.when(form.rlike(r"\p{IsCyrillic}"), in_script("cyrillic")).when(form.rlike(r"\p{IsGreek}"), in_script("greek")).otherwise(in_script("latin"))


def surrogate(kind: Column, form: Column, attempt: Column, key: str) -> Column:
    """The replacement of a unit: an address, a name's part, or the digits of a number."""
    return bind(
        _stream(kind, form, attempt, key),
        lambda s: F.when(kind == "email", _email(form, s, attempt, key)).when(kind == "address", _address(s)).when(kind == "card", _card(form, s)).when(kind == "name", _name(form, s, attempt)).otherwise(_phone(form, s, attempt)),
    )


def _taken(kind: Column, form: Column, made: Column) -> Column:
    """The canonical form that a surrogate has itself."""
    return F.when(kind == "name", F.concat(F.substring(form, 1, 2), F.lower(made))).otherwise(made)


def _spell(raw: Column, digits: Column) -> Column:
    """The digits with the separators of raw; digits that raw has no place for come at the end."""
    nth = lambda i: F.length(F.regexp_replace(F.substring(raw, F.lit(1), i + 1), "[^0-9]", ""))
    placed = F.array_join(F.transform(F.split(raw, ""), lambda c, i: F.when(c.rlike("^[0-9]$"), F.substring(digits, nth(i), F.lit(1))).otherwise(c)), "")
    return F.concat(placed, F.substring(digits, F.length(F.regexp_replace(raw, "[^0-9]", "")) + 1, F.lit(1 << 30)))


def replacement(kind: Column, raw: Column, names: Column, tries: Column, key: str) -> Column:
    """What stands for one spelling of an entity; tries: map from kind and form to the attempt, for those that clashed."""

    def of(u: Column) -> Column:
        return surrogate(u["kind"], u["form"], F.coalesce(F.try_element_at(tries, F.concat_ws("\x1f", u["kind"], u["form"])), F.lit(0)), key)

    def spelled(made: Column) -> Column:
        first = F.get(made, F.lit(0))
        name = F.concat(F.regexp_extract(raw, TITLE, 0), F.array_join(F.zip_with(made, name_parts(raw), lambda m, p: F.concat(m, F.regexp_extract(p, "[ -]$", 0))), ""))
        zeros = F.when((kind == "phone") & raw.startswith("00"), "00").otherwise("")
        return F.when(kind == "name", name).when(kind.isin("card", "phone"), _spell(raw, F.concat(zeros, F.regexp_replace(first, r"^\+", "")))).otherwise(first)

    return bind(F.transform(units(kind, raw, names), of), spelled)


def entities(pieces: DataFrame) -> DataFrame:
    """(kind, form) of the distinct units. pieces: (raws, names, ..)."""
    each = pieces.select("names", F.explode("raws").alias("raw")).select("raw", "names", entity_type(F.col("raw")).alias("kind"))
    return each.select(F.explode(units(F.col("kind"), F.col("raw"), F.col("names"))).alias("u")).select("u.kind", "u.form").distinct()


def attempts(found: DataFrame, key: str, rounds: int = 60) -> DataFrame:
    """(kind, form, attempt) of the units whose first surrogate clashed. found: from entities()."""
    found = common.materialize(found.withColumn("attempt", F.lit(0)), "entities")
    changed = None
    for _ in range(rounds):
        spread = found.repartition(int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # few bytes, much work
        made = spread.withColumn("made", _taken(F.col("kind"), F.col("form"), surrogate(F.col("kind"), F.col("form"), F.col("attempt"), key)))
        made = common.materialize(made, "surrogates")
        shared = made.groupBy("kind", "made").agg(F.min(F.struct("attempt", "form")).alias("stays"), F.count("*").alias("n")).where("n > 1")
        losers = made.join(shared.hint("merge"), ["kind", "made"]).where(F.col("form") != F.col("stays.form")).select("kind", "form")
        real = made.join(found.select("kind", F.col("form").alias("made")).hint("merge"), ["kind", "made"]).select("kind", "form")
        again = common.materialize(losers.unionByName(real).distinct(), "clashes")
        common.discard(made)
        if again.isEmpty():
            return found.where("attempt > 0").select("kind", "form", "attempt") if changed else found.limit(0).select("kind", "form", "attempt")
        changed = True
        before, found = found, common.materialize(
            found.join(again.withColumn("again", F.lit(1)).hint("merge"), ["kind", "form"], "left").select("kind", "form", (F.col("attempt") + F.coalesce("again", F.lit(0))).alias("attempt")),
            "entities",
        )
        common.discard(before)
        common.discard(again)
    raise RuntimeError(f"surrogates still clash after {rounds} rounds; the space of a type is too small for its entities")


def redact(df: DataFrame, text_col: str = "text", key: str | None = None) -> DataFrame:
    """df with the text's entities replaced, and pii_entities: array<struct<kind, s, e>> of the original's code points."""
    key = key or session_key(df.sparkSession)
    text = F.col(f"`{text_col}`").cast("string")
    others = [c for c in df.columns if c != text_col]
    none = F.array().cast("array<string>")
    row = df.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in others]).alias("held"), text.alias("text"), F.coalesce(F.when(text.rlike(SIGN), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))), none).alias("raws"))
    row = row.withColumn("names", F.when(F.size("raws") > 0, titled_parts(F.col("raws"))).otherwise(F.array()).cast(PART))
    row = row.withColumn("pattern", F.when(F.size("names") > 0, own_names(F.col("names"))))
    # a text is held once: as what lies between its entities, or whole if it has none
    gaps = F.when(F.col("pattern").isNotNull(), F.split("text", F.col("pattern"), -1)).when(F.size("raws") > 0, F.split("text", ENTITY, -1))
    raws = F.when(F.col("pattern").isNotNull(), F.regexp_extract_all("text", F.col("pattern"), F.lit(0))).otherwise(F.col("raws"))
    row = row.select("held", raws.alias("raws"), "names", gaps.alias("gaps"), F.when(F.size("raws") == 0, F.col("text")).alias("plain"))
    row = common.materialize(row.withColumn("row", F.monotonically_increasing_id()), "entity-pieces")
    retried = common.materialize(attempts(entities(row), key), "retried")
    if retried.isEmpty():
        row = row.withColumn("tries", F.create_map().cast("map<string,int>"))
    else:
        each = row.select("row", "names", F.explode("raws").alias("raw")).select("row", F.explode(units(entity_type(F.col("raw")), F.col("raw"), F.col("names"))).alias("u")).select("row", "u.kind", "u.form").distinct()
        each = common.skew_join(each, retried, ["kind", "form"])
        tries = each.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("\x1f", "kind", "form"), "attempt"))).alias("tries"))
        row = row.join(tries.hint("merge"), "row", "left").withColumn("tries", F.coalesce("tries", F.create_map().cast("map<string,int>")))
    known = F.transform(F.arrays_zip(F.slice("gaps", F.lit(1), F.size("raws")).alias("gap"), F.col("raws").alias("raw")), lambda x: F.struct(x["gap"].alias("gap"), x["raw"].alias("raw"), entity_type(x["raw"]).alias("kind")))
    row = row.withColumn("known", F.when(F.size("raws") > 0, known))

    def placed(xs: Column) -> Column:
        starts = prefix_sums(F.transform(xs, lambda x: F.length(x["gap"]) + F.length(x["raw"])))
        return F.zip_with(xs, starts, lambda x, at: F.struct(x["kind"].alias("kind"), (at + F.length(x["gap"])).alias("s"), (at + F.length(x["gap"]) + F.length(x["raw"])).alias("e")))

    pieces = F.transform("known", lambda x: F.concat(x["gap"], replacement(x["kind"], x["raw"], F.col("names"), F.col("tries"), key)))
    replaced = F.when(F.size("raws") > 0, F.concat(F.array_join(pieces, ""), F.element_at("gaps", -1))).otherwise(F.col("plain"))
    empty = F.array().cast("array<struct<kind:string,s:int,e:int>>")
    out = row.select("held", replaced.alias("replaced"), F.when(F.size("raws") > 0, bind(F.col("known"), placed)).otherwise(empty).alias("pii_entities"))
    return out.select(*[F.col("replaced").alias(c) if c == text_col else F.col(f"held.`{c}`").alias(c) for c in df.columns], "pii_entities")


def op10_pii_surrogates(spark, sf_dir: str) -> DataFrame:
    # a configured key counts; the fixed one makes the query's rows the same in all sessions, and is no secret
    rows = redact(common.table(spark, sf_dir, "documents").select("doc_id", "text"), key=spark.conf.get(KEY, None) or QUERY_KEY)
    rendered = F.transform("pii_entities", lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string")))
    return rows.select("doc_id", "text", F.size("pii_entities").cast("long").alias("n_entities"), F.array_join(rendered, ",").alias("entities"))
