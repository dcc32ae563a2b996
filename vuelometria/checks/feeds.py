"""JSON feeds written from the bound tables, as input for the reader and ingestion checks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.binding import BoundTables


def _flight_record() -> Column:
    def end(prefix: str) -> Column:
        return F.struct(
            F.col(f"{prefix}_airport").alias("airport"),
            F.col(f"{prefix}_iata").alias("iata"),
            F.col(f"{prefix}_scheduled").alias("scheduled"),
            F.col(f"{prefix}_delay_min").alias("delay"),
        ).alias(prefix)

    return F.struct(
        F.col("flight_date").cast("string").alias("flight_date"),
        "flight_status",
        end("departure"),
        end("arrival"),
        F.struct(F.col("airline_name").alias("name"), F.col("airline_iata").alias("iata")).alias("airline"),
        F.struct(F.col("flight_number").alias("number")).alias("flight"),
    )


def _weather_record() -> Column:
    current = {
        "temp_c": "temp_c", "temp_f": "temp_f", "humidity": "humidity", "wind_kph": "wind_kph",
        "wind_direction": "wind_dir", "pressure_mb": "pressure_mb", "precip_mm": "precip_mm",
        "cloud_coverage": "cloud", "visibility_km": "vis_km", "chance_of_rain": "chance_of_rain",
    }
    return F.struct(
        F.struct(
            F.col("city").alias("name"), "region", "country", F.col("latitude").alias("lat"),
            F.col("longitude").alias("lon"), F.concat("local_time", F.lit(" 9:05")).alias("localtime"),
        ).alias("location"),
        F.struct(
            *[F.col(c).alias(name) for c, name in current.items()],
            F.struct(F.col("condition").alias("text")).alias("condition"),
        ).alias("current"),
    )


def _delay_record() -> Column:
    return F.struct(
        F.col("user_id").alias("userId"),
        F.col("incident_id").alias("id"),
        F.col("incident_title").alias("title"),
        F.col("is_resolved").alias("completed"),
    )


# feed -> (date column, day of the pull, record)
_FEEDS = {
    "flights": ("flight_date", lambda d: F.trunc(d, "month"), _flight_record),
    "weather": ("weather_date", lambda d: F.trunc(d, "month"), _weather_record),
    "delays": ("report_date", lambda d: d, _delay_record),
}


def land_feed(t: BoundTables, feed: str, path: str, where: Column | None = None) -> str:
    """Writes a bound table as pulls: directories <feed>_<day>_<time> with one JSON document each.

    A document holds the records of one day (one month of flights or weather) out of one Arrow
    batch, so its size is bounded however many rows a day has. Rebalancing cuts a large day
    into several tasks. The files are compressed: names and codes repeat in every record.
    """
    date, day, record = _FEEDS[feed]
    rows: DataFrame = getattr(t, feed)
    if where is not None:
        rows = rows.where(where)
    records = (
        rows.select(day(F.col(date)).cast("string").alias("day"), F.col(date).alias("d"), F.to_json(record()).alias("r"))
        .hint("rebalance", F.col("day"))
        .sortWithinPartitions("d")
        .select("day", "r")
    )
    head, tail = ('{"data":[', "]}") if feed == "flights" else ("[", "]")

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = 0
        for batch in batches:
            for label, group in batch.groupby("day", sort=False):
                time = f"{number // 3600:02d}-{number // 60 % 60:02d}-{number % 60:02d}"
                number += 1
                yield pd.DataFrame(
                    {"pull": [f"{feed}_{label}_{time}"], "value": [head + ",".join(group["r"]) + tail]}
                )

    pulls = records.mapInPandas(documents, "pull string, value string")
    pulls.write.mode("append").option("compression", "lz4").partitionBy("pull").text(path)
    return path
