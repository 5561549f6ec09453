"""Queries of the training-data operators and their DuckDB text, by name."""

from __future__ import annotations

import corpus_pipeline

from . import op1_mixing, op2_token_ids, op3_licenses, op4_secrets, op5_quality, op6_suffix_dedup, op7_warc, op8_decontamination, op9_neardup, op10_pii, op11_vector_codes, op12_toxicity, op13_spellings

QUERIES = {
    "op1_mixing": op1_mixing.op1_mixing,
    "op2_token_ids": op2_token_ids.op2_token_ids,
    "op3_licenses": op3_licenses.op3_licenses,
    "op4_secrets": op4_secrets.op4_secrets,
    "op5_quality": op5_quality.op5_quality,
    "op6_suffix_dedup": op6_suffix_dedup.op6_suffix_dedup,
    "op7_warc": op7_warc.op7_warc,
    "op8_decontamination": op8_decontamination.op8_decontamination,
    "op9_neardup": op9_neardup.op9_neardup,
    "op10_pii": op10_pii.op10_pii,
    "op11_vector_codes": op11_vector_codes.op11_vector_codes,
    "op12_toxicity": op12_toxicity.op12_toxicity,
    "op13_spellings": op13_spellings.op13_spellings,
    "pipeline": corpus_pipeline.run,
}

SQL = {
    "op1_mixing": op1_mixing.SQL,
    "op3_licenses": op3_licenses.SQL,
    "op5_quality": op5_quality.SQL,
    "op7_warc": op7_warc.SQL,
    "op8_decontamination": op8_decontamination.SQL,
    "op11_vector_codes": op11_vector_codes.SQL,
    "op13_spellings": op13_spellings.SQL,
}
