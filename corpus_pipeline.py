"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one before it kept; ``run`` writes each result as Parquet in
the shared folder and reads it again for the next stage, so a lost executor costs a re-read at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracelake.llm.common import table
from tracelake.llm.decontaminate import without_test_items
from tracelake.llm.near_dedup import without_near_duplicates
from tracelake.llm.packing import pack_documents
from tracelake.llm.suffix_dedup import cut_repeats
from tracelake.llm.toxicity import without_toxic
from tracelake.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier of labelled neighbours does not reject."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return without_near_duplicates(docs)


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the long strings that a document with a smaller id has too."""
    return cut_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return without_test_items(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeated_strings),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: SQL has neither the classifier nor the tokenizer; tests/llm compares each stage with its operator only, packing by its number of rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
