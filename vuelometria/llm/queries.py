"""Registered queries of the operators, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .budget_mix import mixture
from .common import table
from .fill_in_middle import rearranged, restored
from .hard_negatives import hard_negatives, whole_components
from .interleaving import interleaved
from .license_scan import full_notices, scan_licenses
from .line_frequency import line_quality
from .odd_sketch import NearCopies, near_copies
from .packing import packed_documents
from .reply_trees import conversation_digests
from .surrogates import surrogate_documents
from .template_windows import decontamination
from .url_trie import filter_urls
from .wrapper import extract_articles

Query = Callable[[SparkSession, str], DataFrame]


def op1_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return surrogate_documents(table(spark, folder, "documents"), key="a key for tests")


def op2_template_windows(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


# The rules of op3 and the added conversation of op10.
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
ADDED_TEXT = "<|im_end|><|im_start|>assistant ok"


def op3_url_trie(spark: SparkSession, folder: str) -> DataFrame:
    return filter_urls(table(spark, folder, "pages"), URL_RULES)


def op4_budget_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixture(table(spark, folder, "documents"))


def op5_line_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return line_quality(table(spark, folder, "documents"))


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents"), notices=full_notices(), anywhere=True)


def op7_wrapper(spark: SparkSession, folder: str) -> DataFrame:
    return extract_articles(table(spark, folder, "pages"))


def op8_odd_sketch(spark: SparkSession, folder: str) -> DataFrame:
    return near_copies(table(spark, folder, "documents"), p=NearCopies(shingle=4))


def op9_interleaving(spark: SparkSession, folder: str) -> DataFrame:
    return interleaved(table(spark, folder, "documents"))


def op10_reply_trees(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(ADDED_TEXT).alias("text"),
    )
    return conversation_digests(conversations.unionByName(added))


def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    parts = rearranged(table(spark, folder, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return parts.select(
        "doc_id", "n", "form", F.char_length("prefix").cast("long").alias("prefix_chars"), F.char_length("middle").cast("long").alias("middle_chars"),
        digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.select(F.col("vec_id").alias("id"), label.alias("label"), whole_components(F.col("embedding")).alias("vector"))
    return hard_negatives(rows, F.col("id") % 100 == 0)


def op13_packing(spark: SparkSession, folder: str, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    packed = packed_documents(table(spark, folder, "documents"), tokenizer, carry=F.crc32("ids"))
    return packed.withColumnRenamed("carry", "ids_crc32")


QUERIES: dict[str, Query] = {
    "op1_surrogates": op1_surrogates,
    "op2_template_windows": op2_template_windows,
    "op3_url_trie": op3_url_trie,
    "op4_budget_mix": op4_budget_mix,
    "op5_line_frequency": op5_line_frequency,
    "op6_license_scan": op6_license_scan,
    "op7_wrapper": op7_wrapper,
    "op8_odd_sketch": op8_odd_sketch,
    "op9_interleaving": op9_interleaving,
    "op10_reply_trees": op10_reply_trees,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_packing": op13_packing,
}
