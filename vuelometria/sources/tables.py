"""Processed and curated Parquet tables, catalog entries, CSV files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import PARTITION, PROCESSED, STAR_CSV


#: Column of ingested rows with the name of their batch. It is in the files, not in the schema of a table.
BATCH = "_batch"


def balanced(df: DataFrame, by: str) -> DataFrame:
    """Rows of one partition value close together, without one task per value.

    The rebalance hint lets adaptive execution cut a date that holds far more rows than the
    others into several tasks and merge the small ones, so neither the number of files per
    date nor the largest task grows out of hand.
    """
    return df.hint("rebalance", F.col(by))


def write_partitioned(
    df: DataFrame, path: str, by: str, mode: str = "append", balance: bool = True, rows_per_file: int = 5_000_000
) -> None:
    """Parquet below ``path`` in directories ``by=value``. ``overwrite`` only replaces the values present in ``df``.

    ``balance=False`` skips the shuffle. It is for input that already comes in the order of
    ``by``, such as landed pulls, where a task meets few values anyway.
    """
    rows = balanced(df, by) if balance else df
    (
        rows.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(by)
        .parquet(path)
    )


def only(df: DataFrame, column: str, dates: Sequence[date | int] | None) -> DataFrame:
    """Partition filter on the given dates, or what stands for them."""
    return df if dates is None else df.where(F.col(column).isin(list(dates)))


def replace_dates(fresh: DataFrame, path: str, column: str, dates: Sequence[date | int] | None) -> DataFrame:
    """Puts the rows of ``dates`` into a daily table, which has one partition per date.

    Whole partitions are written from the records alone, never from the table itself, so a run
    that died half-way is put right by the next one.
    """
    spark = fresh.sparkSession
    if dates is None:
        (
            balanced(fresh, column)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy(column)
            .parquet(path)
        )
    elif dates:
        write_partitioned(fresh, path, column, mode="overwrite")
    return spark.read.schema(fresh.schema).parquet(path)


def read_processed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Processed table with its fixed schema; partitions are found by file discovery."""
    return spark.read.schema(PROCESSED[name]).parquet(path)


def materialize(df: DataFrame, path: str, by: str | None = None) -> DataFrame:
    """Writes ``df`` to a curated location and reads it back.

    With ``by`` only the partitions present in ``df`` are replaced. Later plans know the
    file sizes, so Catalyst decides on broadcasts from real numbers, and nothing is computed twice.
    """
    if by:
        write_partitioned(df, path, by, mode="overwrite")
    else:
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def register_table(spark: SparkSession, database: str, name: str, path: str, feed: str) -> str:
    """External partitioned table over ``path``; returns its qualified name."""
    qualified = f"`{database}`.`{name}`"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {qualified} ({PROCESSED[feed]}) USING parquet "
        f"PARTITIONED BY ({PARTITION[feed]}) LOCATION '{path}' "
        "TBLPROPERTIES ('parquet.compression'='SNAPPY')"
    )
    refresh_partitions(spark, qualified)
    return qualified


def refresh_partitions(spark: SparkSession, table: str) -> None:
    """Adds directories that were written since the last call to the catalog."""
    spark.catalog.recoverPartitions(table)


def register_views(spark: SparkSession, frames: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    """Temporary views for SQL users, one per frame."""
    names = []
    for name, df in frames.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


def read_star_csv(spark: SparkSession, path: str, name: str) -> DataFrame:
    """CSV with header; ``True`` and ``False`` become booleans."""
    return spark.read.schema(STAR_CSV[name]).option("header", "true").option("enforceSchema", "false").csv(path)
