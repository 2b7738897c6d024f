"""Corpus pipeline: quality rules, language, near-duplicates, personal data, packing.

Each stage takes documents and returns documents with the same columns; the last one
returns the pieces of packed sequences. A driver writes each stage's rows and reads them
again as the next one's input; ``run`` does the same in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prodseq.llm.language import keep_known_language
from prodseq.llm.minhash import keep_one
from prodseq.llm.packing import pack
from prodseq.llm.pii import mask_personal_data
from prodseq.llm.quality import keep_good
from prodseq.llm.scratch import Scratch

WINDOW, END_ID = 2048, 1


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy of the quality ledger."""
    return keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; learned from the documents of this stage."""
    return keep_known_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, on five-word shingles at a similarity of 0.8."""
    return keep_one(docs, width=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return mask_personal_data(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of tokens."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), window=WINDOW, end_id=END_ID)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: Language ID and packing by a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents table, each written before the next."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
