"""Feeds from landed JSON files to processed Parquet tables, each file exactly once."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from datetime import date, datetime, timedelta, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import scratch_dir
from ..sources.raw import FILE, ORIGIN, RAW_OPTIONS, flatten, intact, unreadable
from ..sources.schemas import CORRUPT, PARTITION, RAW
from ..sources.tables import BATCH, write_partitioned

FEEDS = ("flights", "weather", "delays")

#: file times and the clock of the driver may differ by this much
CLOCK_SLACK_MINUTES = 60


@dataclass(frozen=True)
class FeedReport:
    feed: str
    rows: int
    error: str | None = None
    #: documents of which nothing could be read, put aside
    quarantined: int = 0
    #: what an expectation says about the counts
    warning: str | None = None


@dataclass(frozen=True)
class Expectation:
    """Bounds on what one run brings of a feed. Outside of them it is a warning, or an error with ``fail``."""

    min_rows: int = 1
    max_rows: int | None = None
    max_quarantined: int | None = None
    fail: bool = False

    def complaint(self, report: FeedReport) -> str | None:
        found = []
        if report.rows < self.min_rows:
            found.append(f"{report.rows} rows, at least {self.min_rows} expected")
        if self.max_rows is not None and report.rows > self.max_rows:
            found.append(f"{report.rows} rows, at most {self.max_rows} expected")
        if self.max_quarantined is not None and report.quarantined > self.max_quarantined:
            found.append(f"{report.quarantined} documents put aside, at most {self.max_quarantined} expected")
        return "; ".join(found) or None


def judged(reports: list[FeedReport], expect: Mapping[str, Expectation]) -> list[FeedReport]:
    """The reports with what their expectations say; a feed that failed keeps its own error."""
    out = []
    for report in reports:
        expected = expect.get(report.feed)
        complaint = expected.complaint(report) if expected and not report.error else None
        if complaint:
            report = replace(report, **{"error" if expected.fail else "warning": complaint})
        out.append(report)
    return out


class FeedError(RuntimeError):
    """At least one feed failed; ``reports`` tells about all of them."""

    def __init__(self, reports: list[FeedReport]):
        self.reports = reports
        super().__init__("; ".join(f"{r.feed}: {r.error}" for r in reports if r.error))


@dataclass(frozen=True)
class FeedPaths:
    raw: str
    processed: str
    checkpoint: str
    #: where documents go that are no JSON; they fail the feed if there is no such place
    quarantine: str | None = None

    @classmethod
    def below(cls, feed: str, raw: str, processed: str, checkpoint: str, quarantine: str | None = None) -> FeedPaths:
        aside = f"{quarantine}/{feed}" if quarantine else None
        return cls(f"{raw}/{feed}", f"{processed}/{feed}", f"{checkpoint}/{feed}", aside)


@dataclass
class FeedRun:
    """A catch-up run; the counts grow with its batches."""

    query: StreamingQuery | None = None
    rows: dict[int, int] = field(default_factory=dict)
    quarantined: dict[int, int] = field(default_factory=dict)

    def finish(self) -> None:
        self.query.awaitTermination()

    def report(self, feed: str, error: str | None = None) -> FeedReport:
        return FeedReport(feed, sum(self.rows.values()), error, sum(self.quarantined.values()))


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema("n bigint").parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return False
    return True


def _observed(seen: Observation, name: str) -> int:
    """An observed count. Where a write turns out to have no rows, the adaptive plan drops what counts them, and nothing is there."""
    try:
        return seen.get[name]
    except Py4JJavaError as exc:
        if "assertion failed" not in str(exc):
            raise
        return 0


def _append_once(df: DataFrame, path: str, by: str, ledger: str, batch: str, balance: bool) -> int:
    """Appends a batch exactly once, also when an earlier attempt died half-way.

    A note in the ledger precedes the write. If it is there already, rows of the earlier attempt may be in the table, also
    on dates that the batch does not have any more, as its files may have changed. Only files written since the note can
    hold them, so these tell the dates of the earlier attempt; they and the dates of the batch are written anew from the
    other rows and the batch, and the other dates are not read. Returns the number of rows.
    """
    spark, note = df.sparkSession, f"{ledger}/{batch}"
    seen = Observation()
    rows = df.withColumn(BATCH, F.lit(batch)).observe(seen, F.count(F.lit(1)).alias("rows"))
    if not _exists(spark, note):
        spark.range(1).select(F.col("id").alias("n"), F.current_timestamp().alias("at")).write.mode("overwrite").parquet(note)
        write_partitioned(rows, path, by, balance=balance)
        return _observed(seen, "rows")
    fresh = scratch_dir(spark, "retry")
    rows.write.parquet(fresh)
    again = spark.read.schema(rows.schema).parquet(fresh)
    if not _exists(spark, path):
        write_partitioned(again, path, by, mode="overwrite", balance=balance)
        return _observed(seen, "rows")
    at = spark.read.schema("at timestamp").parquet(note).first()["at"]

    def mine(table: DataFrame) -> DataFrame:
        return table.where(F.col(BATCH) == batch)

    def others(table: DataFrame) -> DataFrame:
        return table.where(~F.col(BATCH).eqNullSafe(F.lit(batch)))

    _replace_rows(again, path, by, F.lit(at), mine, others, balance)
    return _observed(seen, "rows")


def _replace_rows(
    again: DataFrame,
    path: str,
    by: str,
    since: Column,
    mine: Callable[[DataFrame], DataFrame],
    others: Callable[[DataFrame], DataFrame],
    balance: bool,
) -> None:
    """Puts the stored rows ``again`` in place of the rows ``mine`` of a table, which are in files written after ``since``.

    The dates of both are written anew, with their ``others``; further dates are not read.
    """
    spark = again.sparkSession
    table = spark.read.schema(again.schema).parquet(path)
    started = since - F.expr(f"interval {CLOCK_SLACK_MINUTES} minutes")
    earlier = mine(table.where(F.col("_metadata.file_modification_time") >= started))
    # values of the partition column, bounded by the calendar
    dates = {r[0] for df in (earlier, again) for r in df.select(by).distinct().collect()}
    literal = F.col(by).isin([d for d in dates if d is not None])
    stay = others(table.where(literal | F.col(by).isNull() if None in dates else literal))
    kept = scratch_dir(spark, "retry")
    stay.write.parquet(kept)
    rows = again.unionByName(spark.read.schema(again.schema).parquet(kept))
    left = {r[0] for r in rows.select(by).distinct().collect()}
    write_partitioned(rows, path, by, mode="overwrite", balance=balance)
    for gone in dates - left:  # dates of the earlier rows alone, which an overwrite by date does not touch
        _delete(spark, f"{path}/{by}={'__HIVE_DEFAULT_PARTITION__' if gone is None else gone}")


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def start_feed(
    spark: SparkSession,
    feed: str,
    paths: FeedPaths,
    as_of: date | str | None = None,
    ts: datetime | str | None = None,
    balance: bool = True,
    files_per_batch: int | None = 100_000,
    archive: str | None = None,
) -> FeedRun:
    """Starts one catch-up run over the files that no earlier run has taken.

    The checkpoint remembers the files, and every batch is appended exactly once to a plain partitioned table, which
    batch writers may append to as well. Pulls are small and many; with ``balance`` the parsed rows are gathered by date
    before they are written (a large date by several tasks), so a date gets few files. A backfill of pulls in date order
    does without that shuffle. With ``archive`` the files of finished batches move there, which keeps the listing short.

    A document that is no JSON fails the feed, and its batch is taken again by the next run. With ``paths.quarantine``
    such documents go there with the name of their file, and the others land.
    """
    reader = spark.readStream.schema(RAW[feed]).options(**RAW_OPTIONS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    documents = reader.json(paths.raw).withColumn(FILE, F.col("_metadata.file_path"))
    run = FeedRun()

    def take(batch: DataFrame, number: int) -> None:
        if paths.quarantine is None:
            good = intact(feed, batch)
        else:
            good = intact(feed, batch, "skip")
            broken = batch.where(unreadable(batch)).select(FILE, F.col(CORRUPT).alias("document"))
            seen = Observation()
            broken.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{paths.quarantine}/batch={number}")
            run.quarantined[number] = _observed(seen, "n")
        flat = flatten(feed, good, as_of, ts)
        ledger = f"{paths.checkpoint}/ledger"
        run.rows[number] = _append_once(flat, paths.processed, PARTITION[feed], ledger, f"batch-{number}", balance)

    run.query = (
        documents.writeStream.foreachBatch(take).option("checkpointLocation", paths.checkpoint).trigger(availableNow=True).start()
    )
    return run


def ingest_incremental(
    spark: SparkSession,
    feed: str,
    paths: FeedPaths,
    as_of: date | str | None = None,
    ts: datetime | str | None = None,
    balance: bool = True,
) -> int:
    """Takes the new files of one feed; returns the number of rows added."""
    run = start_feed(spark, feed, paths, as_of, ts, balance)
    run.finish()
    return run.report(feed).rows


def replay(
    spark: SparkSession,
    feed: str,
    paths: FeedPaths,
    since: datetime,
    until: datetime | None = None,
    as_of: date | str | None = None,
    ts: datetime | str | None = None,
    balance: bool = True,
    raw: str | None = None,
) -> int:
    """Takes the files landed from ``since`` to ``until`` (now, if not given) again, after a mapping was mended, say.

    Their rows give way to those that the files give today, also on dates that have none any more; rows of other files,
    and of writers that name no file, stay. Times are those of the files and carry a zone. Only files of the table
    written since then are searched, and only the dates concerned are written. New files are taken first, as by any run, so a
    later run does not bring them twice. It can be repeated. ``raw`` is for pulls that were archived. Returns the number of rows.
    """
    until = until or datetime.now(timezone.utc)
    ingest_incremental(spark, feed, paths, as_of, ts, balance)
    # both bounds of the reader are exclusive, and times of files are in milliseconds
    bounds = {
        "modifiedAfter": (since - timedelta(milliseconds=1)).astimezone(timezone.utc).isoformat(),
        "modifiedBefore": (until + timedelta(milliseconds=1)).astimezone(timezone.utc).isoformat(),
    }
    place = raw or paths.raw
    name = F.col("_metadata.file_path")
    documents = spark.read.schema(RAW[feed]).options(**RAW_OPTIONS, **bounds).json(place).withColumn(FILE, name)
    good = intact(feed, documents, "fail" if paths.quarantine is None else "skip")
    seen = Observation()
    rows = flatten(feed, good, as_of, ts).withColumn(BATCH, F.lit(f"replay-{uuid.uuid4().hex}"))
    fresh, listed = scratch_dir(spark, "replay"), scratch_dir(spark, "replay")
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(fresh)
    again = spark.read.schema(rows.schema).parquet(fresh)
    # names only, the contents are not read
    pulls = spark.read.format("binaryFile").options(recursiveFileLookup="true", **bounds).load(place)
    pulls.select(name.alias(ORIGIN)).write.parquet(listed)
    files = spark.read.schema(f"{ORIGIN} string").parquet(listed)
    if _exists(spark, paths.processed):
        _replace_rows(
            again, paths.processed, PARTITION[feed], F.lit(since),
            lambda table: table.join(files, ORIGIN, "left_semi"), lambda table: table.join(files, ORIGIN, "left_anti").select(again.columns),
            balance,
        )
    else:
        write_partitioned(again, paths.processed, PARTITION[feed], balance=balance)
    return _observed(seen, "rows")


def run_feeds(
    spark: SparkSession,
    paths: Mapping[str, FeedPaths],
    as_of: date | str | None = None,
    ts: datetime | str | None = None,
    balance: bool = True,
) -> list[FeedReport]:
    """Runs all feeds side by side. A broken feed does not stop the others; it raises at the end."""
    running: dict[str, FeedRun | str] = {}
    for feed, place in paths.items():
        try:
            running[feed] = start_feed(spark, feed, place, as_of, ts, balance)
        except Exception as exc:  # a feed must not take the others down
            running[feed] = _reason(exc)
    reports = []
    for feed, run in running.items():
        if isinstance(run, str):
            reports.append(FeedReport(feed, 0, run))
            continue
        try:
            run.finish()
            reports.append(run.report(feed))
        except Exception as exc:
            reports.append(run.report(feed, _reason(exc)))
    if any(r.error for r in reports):
        raise FeedError(reports)
    return reports


def _reason(exc: Exception) -> str:
    lines = str(exc).strip().splitlines()
    return lines[0] if lines else type(exc).__name__


class feed_counts:
    """Counts the rows of batch writes while they run, without reading the input again.

    ``df = counts.watch("flights", df)`` before the write, ``counts.rows`` after it.
    """

    def __init__(self) -> None:
        self._observed: dict[str, Observation] = {}

    def watch(self, feed: str, df: DataFrame) -> DataFrame:
        self._observed[feed] = Observation(feed)
        return df.observe(self._observed[feed], F.count(F.lit(1)).alias("rows"))

    @property
    def rows(self) -> dict[str, int]:
        return {feed: seen.get["rows"] for feed, seen in self._observed.items()}
