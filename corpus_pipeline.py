"""From raw documents to training shards: quality, near copies, benchmark leaks, mixture, shards.

Every stage takes (spark, docs, sf_dir), works on all documents that the stage before kept, and returns the columns of
documents; the last one adds shard and slot. Between stages the documents are written as Parquet and read again, so a
lost executor costs a stage at most, and a stage can be run again from the one before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vuelometria.llm.budget_mix import mixed_documents
from vuelometria.llm.common import stored, table
from vuelometria.llm.interleaving import sharded_documents
from vuelometria.llm.line_frequency import clean_documents
from vuelometria.llm.odd_sketch import without_near_copies
from vuelometria.llm.template_windows import without_leaks


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that fail a rule, and without boilerplate lines in the others."""
    return clean_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return without_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold an item of the benchmark."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target of their source asks for."""
    return mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with their shard and slot."""
    added = ("shard", "slot")
    names = [c for c in docs.columns if c.lower() not in added]
    return sharded_documents(docs).select(*[f"doc.`{c}`" for c in names], *added)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

# SQL cannot express the seeded choice of the mixture; tests/llm holds the stages against brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
