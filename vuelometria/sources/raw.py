"""Raw JSON feeds: one document per file and pull."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import CORRUPT, RAW

#: Column with the file of a document, where it was taken from the file metadata already.
FILE = "file_path"

#: Column of flattened rows with the file they came from, where ``FILE`` was there. It is in no schema of a table.
ORIGIN = "_file"

#: A pull is a file, or a directory with its files, named <feed>_YYYY-MM-DD_HH-MM-SS.
PULL_DATE = r"_(\d{4}-\d{2}-\d{2})_\d{2}-\d{2}-\d{2}[^/]*(?:/[^/]*)?$"


# A file is one record, its end the only separator. In this mode the JSON reader has the document in memory; with
# ``multiLine`` it goes back to the file for every number that is read as text, 8 KB each, to get its exact digits.
RAW_OPTIONS = {
    "multiLine": "false",
    "lineSep": "\x1e no document has this \x1e",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "recursiveFileLookup": "true",
}


def unreadable(documents: DataFrame) -> Column:
    """Whether nothing of a document could be read. A single value of the wrong kind is NULL and no reason."""
    gone = F.col(CORRUPT).isNotNull()
    for field in documents.columns:
        if field not in (CORRUPT, FILE):
            gone = gone & F.col(field).isNull()
    return gone


def intact(feed: str, documents: DataFrame, broken: str = "fail") -> DataFrame:
    """Documents of which nothing could be read fail the feed, or are left out with ``broken="skip"``.

    The error sits in the values themselves, not in a filter: a filter would come after those that Spark derives
    from an ``explode`` or that a consumer adds, and these drop a document without values before it is looked at.
    A file without any content has no document and gives no rows.
    """
    gone = unreadable(documents)
    if broken != "fail":
        return documents.where(~gone)
    text = F.concat(F.lit(f"{feed}: not a JSON document: "), F.substring(CORRUPT, 1, 200))
    guarded = {
        field.name: F.when(gone, F.raise_error(text).cast(field.dataType)).otherwise(F.col(field.name))
        for field in documents.schema
        if field.name not in (CORRUPT, FILE)
    }
    return documents.withColumns(guarded)


def read_raw(spark: SparkSession, feed: str, path: str, broken: str = "fail") -> DataFrame:
    return intact(feed, spark.read.schema(RAW[feed]).options(**RAW_OPTIONS).json(path), broken)


def read_flights_raw(spark: SparkSession, path: str, broken: str = "fail") -> DataFrame:
    """One row per document; its records sit in the array ``data``."""
    return read_raw(spark, "flights", path, broken)


def read_weather_raw(spark: SparkSession, path: str, broken: str = "fail") -> DataFrame:
    """One row per measurement; a file holds one object or an array of objects."""
    return read_raw(spark, "weather", path, broken)


def read_delays_raw(spark: SparkSession, path: str, broken: str = "fail") -> DataFrame:
    """One row per element of the top-level array of each file."""
    return read_raw(spark, "delays", path, broken)


def explode_data(df: DataFrame) -> DataFrame:
    """One row per element of ``data`` as struct ``f``; empty and missing arrays give no row."""
    return df.select(F.explode("data").alias("f"), *([FILE] if FILE in df.columns else []))


def _origin(raw: DataFrame) -> list[Column]:
    return [F.col(FILE).alias(ORIGIN)] if FILE in raw.columns else []


def with_ingested_at(df: DataFrame, ts: datetime | str | None = None) -> DataFrame:
    """Load time: the time of the running batch, or the given instant."""
    stamp = F.current_timestamp() if ts is None else F.lit(ts).cast("timestamp")
    return df.withColumn("ingested_at", stamp)


def _int(path: str) -> Column:
    return F.col(path).try_cast("int")


def _id(path: str) -> Column:
    """A whole number of 64 bits, also where a pull writes it as text or with decimals."""
    return F.coalesce(F.col(path).try_cast("bigint"), F.col(path).try_cast("decimal(38,6)").try_cast("bigint"))


def flatten_flights(raw: DataFrame, ts: datetime | str | None = None) -> DataFrame:
    flat = explode_data(raw).select(
        F.col("f.flight_date").try_cast("date").alias("flight_date"),
        F.col("f.flight_status").alias("flight_status"),
        F.col("f.departure.airport").alias("departure_airport"),
        F.col("f.departure.iata").alias("departure_iata"),
        F.col("f.departure.scheduled").alias("departure_scheduled"),
        _int("f.departure.delay").alias("departure_delay_min"),
        F.col("f.arrival.airport").alias("arrival_airport"),
        F.col("f.arrival.iata").alias("arrival_iata"),
        F.col("f.arrival.scheduled").alias("arrival_scheduled"),
        _int("f.arrival.delay").alias("arrival_delay_min"),
        F.col("f.airline.name").alias("airline_name"),
        F.col("f.airline.iata").alias("airline_iata"),
        F.col("f.flight.number").alias("flight_number"),
        *_origin(raw),
    )
    return with_ingested_at(flat, ts)


def flatten_weather(raw: DataFrame, ts: datetime | str | None = None) -> DataFrame:
    numbers = {
        "temp_c": "temp_c", "temp_f": "temp_f", "wind_kph": "wind_kph", "pressure_mb": "pressure_mb",
        "precip_mm": "precip_mm", "visibility_km": "vis_km",
    }
    whole_numbers = {"humidity": "humidity", "cloud_coverage": "cloud", "chance_of_rain": "chance_of_rain"}
    texts = {
        "city": "location.name", "region": "location.region", "country": "location.country",
        "local_time": "location.localtime", "wind_direction": "current.wind_dir", "condition": "current.condition.text",
    }
    flat = raw.select(
        *[F.col(source).alias(name) for name, source in texts.items()],
        F.col("location.lat").alias("latitude"),
        F.col("location.lon").alias("longitude"),
        *[F.col(f"current.{source}").alias(name) for name, source in numbers.items()],
        *[_int(f"current.{source}").alias(name) for name, source in whole_numbers.items()],
        # the hour may have one digit, so only the date part is looked at
        F.col("location.localtime").try_cast("date").alias("weather_date"),
        *_origin(raw),
    )
    return with_ingested_at(flat, ts)


def flatten_delays(raw: DataFrame, as_of: date | str | None = None, ts: datetime | str | None = None) -> DataFrame:
    """``report_date`` is the date in the name of the pull, else ``as_of``, else today.

    The name keeps a re-run from stamping old incidents with a new date.
    """
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    file = F.col(FILE) if FILE in raw.columns else F.col("_metadata.file_path")
    pulled = F.regexp_extract(file, PULL_DATE, 1).try_cast("date")
    flat = raw.select(
        _id("userId").alias("user_id"),
        _id("id").alias("incident_id"),
        F.col("title").alias("incident_title"),
        F.col("completed").alias("is_resolved"),
        F.coalesce(pulled, today).alias("report_date"),
        *_origin(raw),
    )
    return with_ingested_at(flat, ts)


def flatten(feed: str, raw: DataFrame, as_of: date | str | None = None, ts: datetime | str | None = None) -> DataFrame:
    if feed == "flights":
        return flatten_flights(raw, ts)
    if feed == "weather":
        return flatten_weather(raw, ts)
    return flatten_delays(raw, as_of, ts)
