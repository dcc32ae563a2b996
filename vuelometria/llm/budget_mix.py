"""Mixing sources to target weights by subset sums.

1. Documents are counted by (source, exact size in words).
2. Sources in code point order, NULL last, get the weights of ``weights`` in turn, and together ``percent`` of all words.
   A target stops at ``most`` times the words of its source; the excess goes to the others by weight until none is above.
   That is one level ``l`` with target = min(most * size, l * weight), found by sorting the sources by size / weight.
3. A source is taken whole as often as its target holds it. For the rest, an equal share of each size is taken, and what
   the rounding leaves open is filled by a bounded knapsack, dynamic programming over the sums that documents of the
   other sizes can make, so that the open words are met exactly, or as near below as they can be.
4. Which documents of a size are taken follows from a seeded hash: the lowest ranks. Ranks come from counts per range of
   hashes and a local order inside of a range, so that a size that holds a third of all documents is many tasks.

The histogram of a source has one row per size, so the longest text bounds it. The knapsack works on little more than
``knapsack_words`` open words, whatever the size of the source, and sees every size.

Defined results: NULL texts and texts without words have size 0 and are taken as often as their source is taken whole;
a source without words has target 0; a NULL source is a source; equal rows are told apart by nothing, so which of them is
taken does not matter; an empty table gives no rows. Runs agree, however the rows are dealt.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, stored, word_count

RANGES = 1024


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (5, 2, 1)
    percent: int = 150
    most: int = 2
    seed: int = 17
    knapsack_words: int = 20_000


def source_targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """(source, source_size, target) from (source, source_size): a row per source, in one ordered window."""
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(in_order) - 1) % len(mix.weights)
    weighted = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in mix.weights]), turn + 1))
    cap = F.col("source_size") * mix.most
    ranked = weighted.withColumn("cap", cap).withColumn("full_at", F.col("cap") / F.col("weight"))
    before = Window.orderBy("full_at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy("full_at", F.col("source").asc_nulls_last()).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = ranked.withColumn(
        "level",  # if all smaller sources are full and this one and the larger are not
        (F.sum("source_size").over(everything) * mix.percent / 100 - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        / F.sum("weight").over(onward),
    )
    # sources are full as long as the level is above what they hold; the first that is not gives the level
    level = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "level"))).over(everything).level
    return levels.select(
        "source", "source_size",
        F.when(F.col("source_size") == 0, 0.0)
        .otherwise(F.least(F.col("cap").cast("double"), F.coalesce(level * F.col("weight"), F.col("cap").cast("double"))))
        .alias("target"),
    )


def _knapsack(left: dict[int, int], words: int) -> dict[int, int]:
    """Counts of sizes, up to those of ``left``, whose sum is as near below ``words`` as any."""
    # bit b of ``reached`` says that a sum of b words can be made; the steps are kept to walk back
    mask = (1 << (words + 1)) - 1
    reached, steps = 1, []
    for size in sorted(s for s, n in left.items() if n and s <= words):
        n, lump = left[size], 1
        while n and size * lump <= words:
            k = min(lump, n)
            steps.append((size, k, reached))
            reached |= (reached << (size * k)) & mask
            n -= k
            lump *= 2
        if reached >> words & 1:
            break
    best, out = reached.bit_length() - 1, {}
    for size, k, earlier in reversed(steps):
        if not earlier >> best & 1:
            out[size] = out.get(size, 0) + k
            best -= size * k
    return out


def fill(sizes: list[int], counts: list[int], words: int, knapsack_words: int) -> dict[int, int]:
    """How many documents of each size to take for ``words`` words, no more than ``counts``; deterministic.

    The equal share of each size is only given up, by quarters, where the sum cannot be met with it.
    """
    have = {s: n for s, n in zip(sizes, counts) if s}
    total = sum(s * n for s, n in have.items())
    words = min(words, total)
    best: dict[int, int] = {}
    for quarters in (4, 3, 2, 1, 0) if words > 0 else ():
        taken = {s: n * words * quarters // (4 * total) for s, n in have.items()}
        open_words = words - sum(s * n for s, n in taken.items())
        # from the longest size down, until little more than the budget of the knapsack is open
        for s in sorted(have, reverse=True):
            n = min(have[s] - taken[s], max(0, open_words - knapsack_words) // s)
            taken[s] += n
            open_words -= n * s
        for s, n in _knapsack({s: n - taken[s] for s, n in have.items()}, open_words).items():
            taken[s] += n
        if sum(s * n for s, n in taken.items()) > sum(s * n for s, n in best.items()):
            best = taken
        if sum(s * n for s, n in best.items()) == words:
            break
    return {s: n for s, n in best.items() if n}


def _plan_udf(mix: Mix):
    def plan(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size")
        sizes, counts = rows["size"].tolist(), rows["n"].tolist()
        words, target = int(rows["source_size"].iloc[0]), rows["target"].iloc[0]
        whole = int(target // words) if words else 0
        extra = fill(sizes, counts, round(target) - whole * words, mix.knapsack_words)
        return pd.DataFrame(
            {
                "source": rows["source"].iloc[0], "size": sizes, "source_size": words, "target": target, "whole": whole,
                "extra": [extra.get(s, 0) for s in sizes],
            }
        )

    return plan


def mixed(docs: DataFrame, carry: Column, text: str, source: str, id_col: str, mix: Mix) -> DataFrame:
    """One row per document: doc (what ``carry`` says), size, source, source_size, target and ``times`` it is taken."""
    order = F.xxhash64(F.lit(mix.seed), docs[id_col], docs[text])
    rows = docs.select(
        carry.alias("doc"), docs[source].alias("source"), word_count(docs[text]).alias("size"), order.alias("order")
    ).withColumn("part", F.pmod(F.shiftright("order", 20), F.lit(RANGES)))
    # parts are dealt by the low bits of the order above 20, so the order inside of a size is (part, order)
    counts = stored(rows.groupBy("source", "size", "part").agg(F.count("*").alias("n")), "sizes")
    histogram = counts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    targets = source_targets(histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), mix)
    targets = targets.withColumnRenamed("source", "t_source")
    planned = (
        histogram.join(targets, F.col("source").eqNullSafe(F.col("t_source")))
        .select("source", "size", "n", "source_size", "target")
        .groupBy("source")
        .applyInPandas(
            _plan_udf(mix), "source string, size bigint, source_size bigint, target double, whole bigint, extra bigint"
        )
    )
    # how many of the extra documents of a size fall into each range of hashes
    p = stored(planned, "plan").withColumnsRenamed({"source": "p_source", "size": "p_size"})
    before = F.sum("n").over(Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    quota = (
        counts.withColumn("before", F.coalesce(before, F.lit(0).cast("long")))
        .join(p, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size")))
        .select(
            F.col("source").alias("q_source"), F.col("size").alias("q_size"), F.col("part").alias("q_part"),
            "source_size", "target", "whole", (F.col("extra") - F.col("before")).alias("quota"),
        )
    )
    local = F.row_number().over(Window.partitionBy("source", "size", "part").orderBy("order"))
    joined = rows.withColumn("rank", local).join(
        quota,
        F.col("source").eqNullSafe(F.col("q_source")) & (F.col("size") == F.col("q_size")) & (F.col("part") == F.col("q_part")),
    )
    times = F.col("whole") + (F.col("rank") <= F.col("quota")).cast("long")
    return joined.select("doc", "size", "source", "source_size", "target", times.alias("times"))


def mixture(docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id", mix: Mix = Mix()) -> DataFrame:
    """One row per document: id, size, source_size, target and ``taken``, the words that the mix takes of it."""
    return mixed(docs, docs[id_col], text, source, id_col, mix).select(
        F.col("doc").alias(id_col), "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken")
    )


def mixed_documents(docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id", mix: Mix = Mix()) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs``.

    What is taken is decided on row numbers; the rows themselves are only joined to them.
    """
    kept = numbered(docs, "rows")
    doc = kept["doc"]
    narrow = kept.select("row", doc[id_col].alias("id"), doc[text].alias("text"), doc[source].alias("source"))
    times = mixed(narrow, narrow["row"], "text", "source", "id", mix).where("times > 0")
    taken = kept.join(times.select(F.col("doc").alias("row"), "times"), "row")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("doc.*")
