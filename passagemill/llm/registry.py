"""Queries of this package and, where SQL can express them, the SQL that gives the same rows."""

from __future__ import annotations

from . import decontam, exact_dedup, hard_negatives, langid, lexical, line_dedup, packing, pii, quality, secret_scan, simhash, toxicity, warc_zip

QUERIES = {
    "op1_secret_scan": secret_scan.op1_secret_scan,
    "op2_simhash_dedup": simhash.op2_simhash_dedup,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_warc_zip": warc_zip.op4_warc_zip,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_line_dedup": line_dedup.op6_line_dedup,
    "op7_language_id": langid.op7_language_id,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_decontamination": decontam.op9_decontamination,
    "op10_pii_surrogates": pii.op10_pii_surrogates,
    "op11_ranked_lexical": lexical.op11_ranked_lexical,
    "op12_quality_cnn": quality.op12_quality_cnn,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}

ORACLES = {**secret_scan.SQL, **warc_zip.SQL, **exact_dedup.SQL, **line_dedup.SQL, **langid.SQL, **decontam.SQL, **lexical.SQL, **hard_negatives.SQL}
