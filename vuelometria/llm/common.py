"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir

# The white space that separates words, as a pattern and as characters.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column, lower: bool = False) -> Column:
    """The words of a text in order, with A-Z in lower case if asked for; none for NULL."""
    # the condition looks at the text as it is, up to its first word, so the whole text is gone through once
    cased = lower_ascii(text) if lower else text
    return F.when(text.rlike(WORD), F.split(F.btrim(cased, F.lit(BLANKS)), GAP)).otherwise(F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else untouched."""
    return F.translate(text, _UPPER, _UPPER.lower())


def row_key(*cols: Column) -> list[Column]:
    """Two hashes (96 bits) of the columns, NULL and empty text told apart. Rows that are equal in them share the key."""
    parts = [x for c in cols for x in (c.isNull(), c)]
    return [F.xxhash64(*parts).alias("k1"), F.hash(*parts).alias("k2")]


def whole_row(df: DataFrame) -> Column:
    """All columns of a row as one struct, so that no column added later can clash with them."""
    return F.struct(*[df[f"`{c}`"].alias(c) for c in df.columns])


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: computed once, and safe when executors are lost."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` as struct ``doc``, each with a number ``row`` of its own, written so that numbers stay as they are.

    What is decided on a few columns finds its way back by the number, so a row is shuffled once, and no key is skewed.
    """
    return stored(df.select(whole_row(df).alias("doc"), F.monotonically_increasing_id().alias("row")), label)


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
