"""From documents to token ids: five stages, each written as Parquet and read again as the next one's documents.

Quality rules drop boilerplate lines and rejected documents, near-duplicate groups keep one document, documents with a benchmark window go,
the rest is mixed to target weights (documents taken several times appear several times), and the mix is
encoded and read back.  All stages but the last return the columns of documents.

A lost executor costs its tasks only: stages are Parquet tables, and inside a stage only such tables cut the lineage.
Null and empty texts fail the quality rules, so later stages see none from this pipeline; each stage handles them by
itself all the same (see its operator).  An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from yieldlens.llm import op1_mixing, op2_token_ids, op5_quality, op8_decontamination, op9_neardup
from yieldlens.llm.text import table
from yieldlens.session import cut_lineage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without their boilerplate lines."""
    return op5_quality.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return op9_neardup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark windows."""
    return op8_decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, as often as it takes them; the one at the cut of a source's budget is cut there."""
    return op1_mixing.apply_mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of the mix, from the files written."""
    return op2_token_ids.read_ids(spark, op2_token_ids.write_ids(docs))


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("token_ids", token_ids),
]

#: Signatures and the tokenizer can't be expressed in SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
