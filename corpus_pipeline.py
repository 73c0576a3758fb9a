"""Pipeline over ``documents``: from raw text to packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept; every result is written as Parquet and read again.  All stages but
the last return the columns of documents.  No stage but the line dedup can be
said in SQL, so the whole is tested against brute force instead.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from telemetry_qc.llm.common import DOC_COLUMNS, documents, saved, table
from telemetry_qc.llm.kneser_ney import keep_good
from telemetry_qc.llm.line_windows import dedup_lines
from telemetry_qc.llm.order_minhash import keep_one
from telemetry_qc.llm.queries import SURROGATE_KEY
from telemetry_qc.llm.sos_packing import pack_documents
from telemetry_qc.llm.surrogates import replace_entities


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity their language's trusted text allows."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the lines of repeated three-line windows; documents that lose
    all of them stay, empty."""
    return dedup_lines(docs).select(*DOC_COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return keep_one(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Surrogates for personal data and secrets."""
    return replace_entities(docs, SURROGATE_KEY).select(*DOC_COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), " ?" in public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("private", private),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(table(spark, sf_dir, "documents"))
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
