"""The corpus pipeline: each stage's rows are written and read again as the next one's documents.

Defined cases, as the stages have them: a null text is an empty one and stays as long as no copy of it does (all texts without
words are copies of each other); rows without an id go through every stage like others; repeated rows are copies; extra columns
are kept, whatever their names, up to packing; an empty table gives an empty one. A stage's own tables and those of the stage
before are deleted as soon as its rows are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from passagemill.llm import common, decontam, line_dedup, near, packing, toxicity
from passagemill.sources import scratch

#: All but the last return the columns of documents; the last one the packed pieces.
STAGES = [
    ("toxicity", toxicity.stage),
    ("line_dedup", line_dedup.stage),
    ("simhash_dedup", near.stage),
    ("decontamination", decontam.stage),
    ("best_fit_packing", packing.stage),
]

#: SQL can express none of the stages but the line dedup's equal lines; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what the stages keep of the table documents."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        point, before = scratch.mark(), docs
        docs = common.materialize(stage(spark, before, sf_dir), f"stage-{name}")
        scratch.discard_since(spark, point, docs)
        common.discard(before)
    return docs
