"""From raw documents to token digests: five stages of the training-data operators.

Each stage takes (spark, docs, sf_dir), works on all documents its predecessor kept and returns the columns of documents;
the last returns the token digests of what is left. run() writes each stage as Parquet to the shared folder and reads it
again as the next one's docs, so that a lost executor never reaches back beyond a stage.

Null, empty and wordless texts fail the quality rules. Rows are judged as rows: repeated doc_ids and null ones are told apart
by a number of the row's own, so of equal rows the first stays. Columns of other names pass through all stages but the last;
very long texts are worked on whole; an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heraldo.llm import bpe, decontaminate, line_dedup, near_dedup, quality
from heraldo.llm.common import persisted, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.filter_documents(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line equals or nearly equals; those left without a word go."""
    return line_dedup.filter_documents(docs)


def near_dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first by doc_id, of each group of near-duplicates over five-word shingles at 0.8."""
    return near_dedup.filter_documents(docs, shingle=5, percent=80)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark, with what passages of it they hold cut out."""
    return decontaminate.filter_documents(docs, table(spark, sf_dir, "benchmark"))


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each document's ids and of the bytes they decode to."""
    return bpe.round_trip(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("near-dedup", near_dedup_documents),
    ("decontamination", decontaminate_documents),
    ("byte-level BPE", encode_documents),
]

#: Hashed registers, an automaton and a tokenizer are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = persisted(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
