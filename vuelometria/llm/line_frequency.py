"""Quality rules by cross-document line frequency.

Lines are normalised and hashed, the distinct documents of each line are counted per host, lines above the limits are
boilerplate and are removed, and a document with next to nothing left is rejected.

* Distinct documents are distinct texts: a document that was crawled a thousand times counts once, so copies do not turn
  each other into boilerplate. Which copy stays is the matter of the deduplication.
* Lines of any length count; the limits on documents alone decide.
* The limit of a host is ``min_documents`` or ``min_share`` of its distinct documents, whichever is larger.

Everything is SQL functions. The texts are read once; what goes on is a row with the hashes of the lines. The hot
line of a hot host is spread by a salt, and counted by partial aggregation.

Defined results: a NULL text has no words and fails; a NULL host is a host of its own; equal rows get equal results, and
count once; lines of white space are no lines; an empty table gives an empty result; other columns are not touched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, row_key, stored, whole_row, words

SYMBOL = "[#*$%&|<>]"
WINDOW = 5
SALTS = 32


@dataclass(frozen=True)
class LineLimits:
    min_documents: int = 20
    min_share: float = 0.005
    min_words_left: int = 5
    min_share_left: float = 0.1


def through(value: Column, f) -> Column:
    """``f(value)`` with the value computed once, also inside of lambdas."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _windows(hashes: Column) -> Column:
    """A hash for each run of five words, in order."""
    n = F.size(hashes)
    return F.when(n < WINDOW, F.array().cast("array<bigint>")).otherwise(
        F.transform(
            F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)])
        )
    )


def _repeated_words(windows: Column) -> Column:
    """How many words lie in a window that occurs again."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(ordered: Column) -> Column:
        again = F.filter(
            F.transform(
                ordered,
                lambda s, j: F.when(
                    s.h.eqNullSafe(F.get(ordered, j - 1).h) | s.h.eqNullSafe(F.get(ordered, j + 1).h), s.i
                ),
            ),
            lambda i: i.isNotNull(),
        )
        return F.sort_array(again)

    def covered(starts: Column) -> Column:
        gaps = F.transform(
            starts, lambda s, j: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, j + 1) - s, F.lit(WINDOW)))
        )
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

    found = through(through(placed, places), covered)
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), found).otherwise(F.lit(0).cast("long"))


def text_measures(docs: DataFrame) -> DataFrame:
    """``docs`` (with a column ``text``) and the measures of each whole text, NULL text as empty."""
    text = "text"
    raw = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(raw, "\n", -1), lambda x: x.rlike(WORD))
    return (
        docs.withColumns({"_words": words(F.col(text)), "_lines": lines})
        .withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
        .withColumn("_windows", _windows(F.col("_hashes")))
        .withColumns(
            {
                "n_words": F.size("_words").cast("long"),
                "word_chars": F.length(F.array_join("_words", "")).cast("long"),
                "n_symbols": F.regexp_count(raw, F.lit(SYMBOL)).cast("long"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                "n_repeat_words": _repeated_words(F.col("_windows")),
            }
        )
        .withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
        .drop("_words", "_hashes", "_windows")
    )


def normalised(line: Column) -> Column:
    """Lower case, digits as 0, white space as one blank."""
    return F.btrim(F.regexp_replace(F.translate(F.lower(line), "123456789", "000000000"), r"[\s]+", " "))


def _line_id(line: Column) -> Column:
    return through(normalised(line), lambda x: F.struct(F.xxhash64(x).alias("h1"), F.hash(x).alias("h2")))


def measured(docs: DataFrame) -> DataFrame:
    """One stored row per document (``id``, ``host``, ``text``): key, measures, ids of its lines, no text."""
    ids = F.transform(
        "_lines",
        lambda x: F.struct(_line_id(x).alias("id"), F.regexp_count(x, F.lit(WORD)).alias("n")),
    )
    return stored(
        text_measures(docs).select(
            "id", "host", F.xxhash64("text").alias("text_id"),
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            *row_key(F.col("host"), F.col("text")),
            ids.alias("lines"),
        ),
        "line-frequency",
    )


def boilerplate_lines(rows: DataFrame, limits: LineLimits) -> DataFrame:
    """The lines above the limit of their host, with the number of distinct documents."""
    hosts = rows.groupBy("host").agg(F.count_distinct("text_id").alias("host_documents"))
    lines = rows.select("host", "text_id", F.explode("lines").alias("line")).select(
        "host", "text_id", "line.id.h1", "line.id.h2"
    )
    counted = lines.groupBy("host", "h1", "h2").agg(F.count_distinct("text_id").alias("documents"))
    often = counted.where(F.col("documents") > limits.min_documents).alias("o")
    per_host = hosts.alias("h")
    return often.join(per_host, F.col("o.host").eqNullSafe(F.col("h.host"))).where(
        F.col("documents") > F.col("host_documents") * limits.min_share
    ).select("o.host", "h1", "h2", "documents", "host_documents")


def removed_lines(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """Per document key that has some: the words on boilerplate lines, and the ids of these lines."""
    salted = lines.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).select(
        F.col("host").alias("b_host"), F.col("h1").alias("b_h1"), F.col("h2").alias("b_h2"), "salt"
    )
    placed = rows.select("host", "k1", "k2", F.posexplode("lines").alias("pos", "line")).select(
        "host", "k1", "k2", "pos", "line.id.h1", "line.id.h2", "line.n",
        F.pmod(F.xxhash64("k1", "pos"), F.lit(SALTS)).cast("int").alias("line_salt"),
    )
    hit = placed.join(
        salted,
        F.col("host").eqNullSafe(F.col("b_host"))
        & (F.col("h1") == F.col("b_h1"))
        & (F.col("h2") == F.col("b_h2"))
        & (F.col("line_salt") == F.col("salt")),
    )
    once = hit.groupBy("k1", "k2", "pos").agg(F.max("n").alias("n"), F.max(F.struct("h1", "h2")).alias("id"))
    return once.groupBy("k1", "k2").agg(F.sum("n").alias("removed_words"), F.collect_set("id").alias("removed"))


def judged(rows: DataFrame, limits: LineLimits) -> DataFrame:
    """``rows`` with ``removed_words``, ``removed`` (line ids) and ``kept``."""
    found = removed_lines(rows, boilerplate_lines(rows, limits))
    left = F.col("n_words") - F.col("removed_words")
    depleted = (F.col("removed_words") > 0) & (
        (left < limits.min_words_left) | (left < F.col("n_words") * limits.min_share_left)
    )
    return (
        rows.drop("lines")
        .join(found, ["k1", "k2"], "left")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("long")))
        .withColumn("kept", ~F.col("base_failed") & ~depleted)
    )


def line_quality(
    docs: DataFrame, text: str = "text", host: str = "source", id_col: str = "doc_id", limits: LineLimits = LineLimits()
) -> DataFrame:
    """One row per document: ``id_col``, measures, ``base_failed``, ``removed_words`` and ``kept``."""
    rows = measured(docs.select(docs[id_col].alias("id"), docs[host].alias("host"), docs[text].alias("text")))
    return judged(rows, limits).select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "removed_words",
    )


def clean_documents(
    docs: DataFrame, text: str = "text", host: str = "source", n_chars: str | None = "n_chars",
    limits: LineLimits = LineLimits(),
) -> DataFrame:
    """The documents that are kept, without their boilerplate lines, with the columns of ``docs``.

    A text without such lines stays as it is to the last character; ``n_chars`` follows a text that was changed.
    """
    parts = docs.select(docs[host].alias("host"), docs[text].alias("text"), whole_row(docs).alias("doc"))
    rows = measured(parts.select(F.lit(None).alias("id"), "host", "text"))
    verdicts = judged(rows, limits).groupBy("k1", "k2").agg(F.first("kept").alias("kept"), F.first("removed").alias("removed"))
    joined = parts.select("doc", *row_key(F.col("host"), F.col("text"))).join(verdicts, ["k1", "k2"]).where("kept")
    whole = F.col("doc").getField(text)
    rest = F.array_join(
        F.filter(
            F.split(whole, "\n", -1),
            lambda x: ~F.array_contains(F.col("removed"), _line_id(x)),
        ),
        "\n",
    )
    changed = F.col("removed").isNotNull()
    out = {c: F.col("doc").getField(c) for c in docs.columns}
    out[text] = F.when(changed, rest).otherwise(whole)
    if n_chars in out:
        out[n_chars] = F.when(changed, F.length(rest).cast("long")).otherwise(out[n_chars])
    return joined.select(*[value.alias(name) for name, value in out.items()])
