"""Running totals over any number of rows: prefix sums by ranges.

Rows are dealt by ranges of their order and written, so that a range is the same rows from then on. The totals of the
ranges, one row each, give every range what comes before it; inside of a range a window adds up. No task sees all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_dir


def prefix_sums(df: DataFrame, order: Sequence[str], columns: Sequence[str], ranges: int | None = None, suffix: str = "_acum") -> DataFrame:
    """Adds the running sum of each column in the order of ``order``, which should tell all rows apart.

    Rows that ``order`` does not tell apart come in any order, next to each other, in one range. NULLs add nothing, and
    NULLs of ``order`` come first. Sums start at the first value that is not NULL, as those of a window do.
    """
    spark = df.sparkSession
    dealt = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    path = scratch_dir(spark, "ranges")
    kept = dealt.withColumn("__range", F.spark_partition_id())
    kept.write.parquet(path)
    kept = spark.read.schema(kept.schema).parquet(path)
    # a row per range: as many as there are partitions
    sums = kept.groupBy("__range").agg(*[F.sum(c).alias(c) for c in columns]).orderBy("__range").collect()
    before, rows = [None] * len(columns), []
    for row in sums:
        rows.append((row["__range"], *before))
        before = [a if b is None else b if a is None else a + b for a, b in zip(before, (row[c] for c in columns))]
    totals = kept.groupBy("__range").agg(*[F.sum(c).alias(f"__{c}") for c in columns])
    offsets = spark.createDataFrame(rows, totals.schema)
    local = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = kept.select("*", *[F.sum(c).over(local).alias(c + suffix) for c in columns])
    joined = inside.join(F.broadcast(offsets), "__range")  # as many rows as ranges
    added = [
        F.when(F.col(f"__{c}").isNull(), F.col(c + suffix)).otherwise(F.col(f"__{c}") + F.coalesce(F.col(c + suffix), F.lit(0))).alias(c + suffix)
        for c in columns
    ]
    return joined.select(*df.columns, *added)
