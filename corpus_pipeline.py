"""Corpus pipeline: documents to packed training sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which ``run`` writes as Parquet and rereads as the
next one's docs. All but the last return the columns of ``documents``.

toxicity    documents that score 0.7 or more are left out
line_dedup  duplicate lines are cut from the texts; every document's row stays,
            its ``n_chars`` counted anew
near_dedup  of each group of near-duplicates the smallest doc_id stays
mixing      documents are repeated or left out so that sources reach their
            target shares, and sorted by training position
packing     one row per piece of a packed sequence of at most 2048 tokens; the
            sequences follow the order that mixing made

Defined cases are those of the operators; an empty table gives empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import distilled, drop_written, table
from strata.llm.line_dedup import without_duplicate_lines
from strata.llm.mixing import mixed_documents
from strata.llm.near_dedup import drop_near_duplicates
from strata.llm.packing import pack
from strata.llm.toxicity import drop_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_duplicate_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # The order in which mixing wrote the documents: part files, then rows.
    return pack(docs, order=[F.col("_metadata.file_name"), F.col("_metadata.row_index")])


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# A fitted classifier, MinHash bands and a tokenizer can't be stated in SQL;
# the tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the packed pieces. Of a stage only
    its output is kept, and that only until the next one has its own."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = distilled(spark, lambda docs=docs, stage=stage: stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            drop_written(before)
        before = docs
    return docs
