"""The four recipes as plans over evidence. Responders that are column expressions keep a plan inside Catalyst; those that
are models go through operators.responder, and give columns of the same names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..functions import text as T
from ..operators import records as R

RECIPES = ("paragraph-qa", "paragraph-qa-qualified", "knowledge-unit-qa", "knowledge-unit-probed-qa")
ALIASES = {"v0": "paragraph-qa", "v1": "knowledge-unit-qa"}
ASK = "What does this passage say?"


def recipe_name(name: str) -> str:
    name = ALIASES.get(name, name)
    if name not in RECIPES:
        raise ValueError(f"unknown recipe {name!r}")
    return name


#: What evidence can say of its source besides ids; a paragraph has it of its evidence.
ORIGIN = ("source_sha256", "anchor_id", "block_id")


def spans(evidence: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """One row for each paragraph of the evidence, with the columns `also` of it."""
    return evidence.select("evidence_id", "document_id", "source_asset_id", *also, F.explode(T.paragraph_spans(F.col("text"))).alias("s")).select(
        "evidence_id", "document_id", "source_asset_id", *also, "s.char_start", "s.char_end", "s.chunk"
    )


def candidate_id() -> Column:
    return H.deterministic_id(F.col("evidence_id"), F.col("char_start"), F.col("char_end"))


def candidates(evidence: DataFrame) -> DataFrame:
    """Paragraph candidates with their provenance; both paragraph recipes start from the same ones."""
    assets = F.when(F.col("source_asset_id").isNotNull(), F.array("source_asset_id")).otherwise(F.array().cast("array<string>"))
    return spans(evidence).select(
        candidate_id().alias("candidate_id"),
        "evidence_id", "document_id", assets.alias("source_asset_ids"), F.array("document_id").alias("document_ids"), F.array("evidence_id").alias("evidence_ids"),
        "char_start", "char_end", F.col("chunk").alias("source_text"),
    )


def template_answers(df: DataFrame, text: str = "source_text") -> DataFrame:
    """The template responder: the answer is the whole passage."""
    return df.withColumn("question", F.lit(ASK)).withColumn("answer", T.strip(F.col(text)))


#: What a record has of its row. The passages, prompts and responses that it was made from stay behind: the dedup's shuffle and sort hold whole rows.
OF_RECORD = (
    "question", "answer", "document_id", "char_start", "source_asset_ids", "document_ids", "evidence_ids", "source_anchor_ids", "knowledge_unit_id", "unit_row", "probe_id", "probe_row", "probe_class",
    "probe_judgment_id", "student_response_id", "selection_reason", "candidate_id", "decision", "quality_label", "reason_codes",
)


def own_lineage() -> dict[str, Column]:
    """A row's own lineage as arrays, which are made of its columns."""
    assets = F.when(F.col("source_asset_id").isNotNull(), F.array("source_asset_id")).otherwise(F.array().cast("array<string>"))
    return {"source_asset_ids": assets, "document_ids": F.array("document_id"), "evidence_ids": F.array("evidence_id")}


def records(df: DataFrame, identity: Column, order: list[str], seed: str = H.SPLIT_SEED, of_identity: tuple[str, ...] | None = None) -> DataFrame:
    """Records of rows with question, answer and lineage: ids, first-wins dedup by messages, group split, roles.

    of_identity: the columns that the identity is made of, in rows whose lineage is their own and whose question is ASK; what can be made of
    few columns is then made after the dedup, whose shuffle and sorts carry rows of their text and a few ids.
    """
    unit = F.col("knowledge_unit_id") if "knowledge_unit_id" in df.columns else F.lit(None).cast("string")
    own = of_identity is not None
    own_made = own_lineage() if own else {}
    needed = {*order, *of_identity, "answer", "evidence_id", "document_id", "source_asset_id"} if own else {*OF_RECORD, *order}
    # half of the hexadecimal digits, which don't compress
    printed = H.message_fingerprint(F.lit(ASK) if own else F.col("question"), F.col("answer"))
    out = df.select(*[c for c in df.columns if c in needed], *([] if own else [identity.alias("record_id")]), F.unhex(printed).alias("fingerprint"))
    out = R.first_wins(out, "fingerprint", order).withColumn("fingerprint", F.lower(F.hex("fingerprint")))
    if own:
        out = out.withColumns({**own_made, "question": F.lit(ASK)}).withColumn("record_id", identity)
    return stamped(out, seed, unit)


def stamped(df: DataFrame, seed: str = H.SPLIT_SEED, unit: Column | None = None) -> DataFrame:
    """df with split group, split and roles by its lineage."""
    group = R.record_group(F.col("source_asset_ids"), F.col("document_ids"), F.lit(None).cast("string") if unit is None else unit, F.col("evidence_ids"))
    return R.research_role(R.with_split(df, group, seed))


def kept_records(rows: DataFrame, order: list[str], seed: str = H.SPLIT_SEED, also: tuple[str, ...] = ()) -> DataFrame:
    """The records of rows with record_id, question, answer, and the ids and origin of their own evidence, without the messages: the dedup carries
    a fingerprint, a few ids and the columns `also` of each row. The messages stay where they were written, until they are published."""
    printed = H.message_fingerprint(F.col("question"), F.col("answer"))
    own = [*order, "document_id", "char_start", "evidence_id", "source_asset_id", *(c for c in ORIGIN if c in rows.columns), *also]
    # half of the hexadecimal digits, which don't compress
    slim = rows.select(*dict.fromkeys(own), F.unhex("record_id").alias("record_id"), F.unhex(printed).alias("fingerprint"))
    out = R.first_wins(slim, "fingerprint", order).drop("fingerprint").withColumn("record_id", F.lower(F.hex("record_id")))
    return stamped(out.withColumns(own_lineage()), seed)


def kept_units(rows: DataFrame, order: list[str], accepted: DataFrame, seed: str = H.SPLIT_SEED) -> DataFrame:
    """The records of the rows whose id (accepted has that column only) is accepted, without the messages, as `kept_records` has them; rows have their lineage."""
    printed = H.message_fingerprint(F.col("question"), F.col("answer"))
    own = [c for c in ("record_id", *OF_RECORD, "source_hashes", *order) if c in rows.columns and c not in ("question", "answer")]
    slim = rows.select(*dict.fromkeys(own), F.unhex(printed).alias("fingerprint"))
    slim = slim.join(accepted.hint("merge"), accepted.columns, "left_semi").withColumn("record_id", F.unhex("record_id"))
    out = R.first_wins(slim, "fingerprint", order).drop("fingerprint").withColumn("record_id", F.lower(F.hex("record_id")))
    return stamped(out, seed, F.col("knowledge_unit_id"))


def paragraph_qa(evidence: DataFrame, dataset: str, answers=template_answers) -> DataFrame:
    made = answers(candidates(evidence))
    identity = H.deterministic_id(dataset, "paragraph-qa", *map(F.col, ("evidence_id", "char_start", "char_end", "question", "answer")))
    return records(made.withColumn("source_asset_id", F.get("source_asset_ids", F.lit(0))), identity, ["document_id", "char_start", "evidence_id"], of_identity=("evidence_id", "char_start", "char_end"))


def qualified(decided: DataFrame, dataset: str) -> DataFrame:
    """Records of the accepted candidates. decided: candidates with question, reference and Q.decide's columns."""
    accepted = decided.where("decision = 'accepted'").withColumn("answer", F.col("reference"))
    identity = H.deterministic_id(dataset, F.col("candidate_id"), F.col("question"), F.col("answer"))
    return records(accepted, identity, ["document_id", "char_start", "candidate_id"])


def knowledge_units(evidence: DataFrame) -> DataFrame:
    """The template discovery: a unit for each sentence of a paragraph."""
    each = spans(evidence).select("evidence_id", "document_id", "source_asset_id", "char_start", F.explode(F.split("chunk", "[.]", -1)).alias("sentence"))
    made = each.withColumn("canonical_statement", T.strip(F.col("sentence"))).where(F.col("canonical_statement") != "")
    assets = F.when(F.col("source_asset_id").isNotNull(), F.array("source_asset_id")).otherwise(F.array().cast("array<string>"))
    return made.select(
        H.deterministic_id(F.col("evidence_id"), F.col("canonical_statement")).alias("knowledge_unit_id"),
        "canonical_statement", F.array("evidence_id").alias("evidence_ids"), assets.alias("source_asset_ids"), F.array("document_id").alias("document_ids"), "document_id", "char_start", "evidence_id", "source_asset_id",
    )


def knowledge_unit_qa(units: DataFrame, accepted: DataFrame, dataset: str) -> DataFrame:
    """Records of the units whose id is accepted (semi join: all rows of an id that was accepted once)."""
    slim = units.select("knowledge_unit_id", "canonical_statement", "evidence_id", "document_id", "source_asset_id", "char_start")
    made = template_answers(slim.join(accepted.select("knowledge_unit_id").distinct(), "knowledge_unit_id", "left_semi"), "canonical_statement")
    identity = H.deterministic_id(dataset, F.col("knowledge_unit_id"), F.col("question"), F.col("answer"))
    return records(made, identity, ["document_id", "char_start", "knowledge_unit_id"], of_identity=("knowledge_unit_id",))


def probe_skeleton(units: DataFrame, probes: int) -> DataFrame:
    """units x probes; none for zero or fewer."""
    if probes <= 0:
        return units.limit(0).withColumn("question_index", F.lit(0)).withColumn("probe_id", F.lit(""))
    out = units.withColumn("question_index", F.explode(F.sequence(F.lit(0), F.lit(probes - 1))))
    return out.withColumn("probe_id", H.deterministic_id(F.col("knowledge_unit_id"), F.col("question_index"), "probe"))


def selected_probes(judged: DataFrame, classes: tuple[str, ...] = ("unknown", "partial"), known_rate: float = 0.0, identity: str = "probe_id") -> DataFrame:
    """Judged probes of the wanted classes, and a hashed sample of the known ones; never an invalid probe."""
    sampled = (F.col("probe_class") == "known") & (H.hash_fraction(F.col(identity)) < known_rate) & F.lit(known_rate > 0)
    return judged.where((F.col("probe_class") != "invalid_probe") & (F.col("probe_class").isin(*classes) | sampled))


def probed_qa(selected: DataFrame, dataset: str) -> DataFrame:
    made = template_answers(selected, "canonical_statement").withColumn("answer", F.concat(F.col("answer"), F.lit(" #"), F.col("question_index")))
    identity = H.deterministic_id(dataset, F.col("probe_id"), F.col("question"), F.col("answer"))
    return records(made, identity, ["document_id", "char_start", "probe_id"], of_identity=("probe_id", "knowledge_unit_id"))


