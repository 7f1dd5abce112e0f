"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, packing.

Each stage takes the documents that its predecessor kept and returns them with the columns of
``documents``; the last one returns the packed pieces. Defined results follow from the operators: a null
or empty text fails the quality rules; repeated rows stay repeated up to near-dedup, which keeps the rows of
the smallest id of a group (rows that repeat that id too); rows with null ids are never near-duplicates;
extra columns ride along; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.decontaminate import remove_documents
from tripmill.llm.line_dedup import line_dedup
from tripmill.llm.near_dedup import near_dedup
from tripmill.llm.packing import pack
from tripmill.llm.quality_rules import quality_rules
from tripmill.llm.shared import stage


def _as_documents(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """``doc_id, text, rest`` in the columns of the documents, with ``n_chars`` of the new text."""
    new = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return changed.select(*(new.get(name, F.col(f"rest.`{name}`")).alias(name) for name in docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; kept ones lose the lines that fail the rules."""
    judged = quality_rules(docs)
    # A generator between the verdict and its filter: pushed below, the filter would judge each text twice,
    # with the words split anew for every comparison.
    judged = judged.select(F.inline(F.array(F.struct(*judged.columns))))
    return _as_documents(judged.filter("kept"), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of at least 20 characters in three documents or more stay in one of them."""
    return _as_documents(line_dedup(docs, min_chars=20, min_docs=3), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity 0.8 or more."""
    kept = near_dedup(docs, width=5, percent=80).groupBy("doc_id").agg(F.bool_or("kept").alias("kept"))
    # Fewer ids go than stay, and null ids stay.
    gone = stage(kept.filter("not kept").select(F.col("doc_id").alias("gone_id")), "gone")
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    return remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of at most 2048 in as few sequences as bin completion finds."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048).drop("gap")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Tokenizing and near-dedup are beyond SQL; the tests hold the pipeline against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
