"""Readers, sinks and ingestion, run on feeds that Spark derives from the bound tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.shape import preview
from ..plans.binding import BoundTables
from ..plans.models import build_models
from ..session import scratch_dir
from ..sources import raw, tables
from ..sources.schemas import PARTITION
from ..streaming.ingest import FeedError, FeedPaths, feed_counts, ingest_incremental, run_feeds
from .feeds import land_feed
from .registry import register

STAMP = "2001-12-01 00:00:00"
HALF = "1998-01-16"


def _landed(t: BoundTables, feed: str) -> str:
    return land_feed(t, feed, scratch_dir(t.spark, "raw") + f"/{feed}")


def _a1(t: BoundTables) -> DataFrame:
    records = raw.explode_data(raw.read_flights_raw(t.spark, _landed(t, "flights")))
    return records.groupBy(F.col("f.flight_status").alias("flight_status"), F.col("f.airline.iata").alias("iata")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("f.departure.delay").cast("int")).alias("minutos")
    )


register(
    "a1_json_flights",
    _a1,
    """select flight_status, airline_iata as iata, count(*) as n, sum(departure_delay_min)::bigint as minutos
       from flights group by 1, 2""",
)


def _a2(t: BoundTables) -> DataFrame:
    measured = raw.read_weather_raw(t.spark, _landed(t, "weather"))
    return measured.groupBy(
        F.col("location.name").alias("city"), F.col("current.condition.text").alias("condition")
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("current.humidity").cast("int")).alias("humedad"))


register(
    "a2_json_weather",
    _a2,
    "select city, condition, count(*) as n, sum(humidity)::bigint as humedad from weather group by 1, 2",
)


def _a3(t: BoundTables) -> DataFrame:
    rows = raw.read_delays_raw(t.spark, _landed(t, "delays"))
    return rows.groupBy("title", "completed").agg(F.count(F.lit(1)).alias("n"))


register(
    "a3_json_delays",
    _a3,
    """select incident_title as title, is_resolved as completed, count(*) as n from delays group by 1, 2""",
)


def _delays_table(t: BoundTables) -> tuple[str, DataFrame]:
    """Processed incidents, written by the batch sink; returns the path and the rows written."""
    flat = raw.flatten_delays(raw.read_delays_raw(t.spark, _landed(t, "delays")), ts=STAMP)
    path = scratch_dir(t.spark, "delays")
    tables.write_partitioned(flat, path, "report_date")
    return path, flat


_DELAY_COLUMNS = "report_date, incident_id, user_id, incident_title, is_resolved"

register(
    "a4_partitioned_sink",
    lambda t: t.spark.read.parquet(_delays_table(t)[0])
    .groupBy("report_date")
    .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("incident_id").alias("incidentes")),
    "select report_date, count(*) as n, count(distinct incident_id) as incidentes from delays group by 1",
)
register(
    "a5_processed",
    lambda t: tables.read_processed(t.spark, _delays_table(t)[0], "delays").drop("ingested_at"),
    f"select {_DELAY_COLUMNS} from delays",
)


def _registered(t: BoundTables) -> DataFrame:
    """Catalog table over a path that gets more partitions after its creation."""
    path = scratch_dir(t.spark, "delays")
    database = f"vuelos_{uuid.uuid4().hex[:12]}"
    first = t.delays.select(
        "user_id", "incident_id", "incident_title", "is_resolved", F.lit(STAMP).cast("timestamp").alias("ingested_at"), "report_date",
    )
    late = F.col("report_date") >= F.lit(HALF).cast("date")
    tables.write_partitioned(first.where(~late), path, "report_date")
    tables.ensure_database(t.spark, database, scratch_dir(t.spark, "db"))
    tables.ensure_database(t.spark, database)  # a second call changes nothing
    name = tables.register_table(t.spark, database, "delays", path, "delays")
    tables.write_partitioned(first.where(late), path, "report_date")
    tables.refresh_partitions(t.spark, name)
    return t.spark.table(name).drop("ingested_at")


register("a6_partitions", _registered, f"select {_DELAY_COLUMNS} from delays")
register(
    "a7_database",
    lambda t: _registered(t).groupBy("is_resolved").agg(F.count(F.lit(1)).alias("n")),
    "select is_resolved, count(*) as n from delays group by 1",
)


def _a8(t: BoundTables) -> DataFrame:
    path = scratch_dir(t.spark, "csv")
    t.dim_fecha.write.option("header", True).csv(path)
    return tables.read_star_csv(t.spark, path, "dim_fecha")


register("a8_csv", _a8, "select * from dim_fecha")


def _a9(t: BoundTables) -> DataFrame:
    """All models as views, queried by name."""
    prefix = f"v{uuid.uuid4().hex[:12]}_"
    tables.register_views(t.spark, build_models(t.flights, t.weather, t.delays), prefix)
    return t.spark.sql(
        f"""select d.trimestre, f.dia_critico, count(*) as n, sum(f.total_vuelos) as vuelos
            from {prefix}fct_flights_analytics f join {prefix}dim_fecha d on d.fecha = f.fecha
            group by d.trimestre, f.dia_critico"""
    )


register(
    "a9_views",
    _a9,
    """select trimestre, dia_critico, count(*) as n, sum(total_vuelos)::bigint as vuelos
       from fct_full join dim_fecha using (fecha) group by 1, 2""",
)


def _a10(t: BoundTables) -> DataFrame:
    """A table of which one half of the dates is replaced by a later run."""
    path = scratch_dir(t.spark, "daily")
    late = F.col("report_date") >= F.lit(HALF).cast("date")
    stale = t.int_delays_daily.withColumn("total_incidentes", F.when(late, F.lit(0)).otherwise(F.col("total_incidentes")))
    tables.materialize(stale, path, "report_date")
    return tables.materialize(t.int_delays_daily.where(late), path, "report_date")


register("a10_table", _a10, "select * from int_delays_daily")


def _a11(t: BoundTables) -> DataFrame:
    """Rows added by three runs: half of the pulls, nothing new, the other half."""
    paths = FeedPaths.below("delays", scratch_dir(t.spark, "raw"), scratch_dir(t.spark, "out"), scratch_dir(t.spark, "ck"))
    late = F.col("report_date") >= F.lit(HALF).cast("date")
    added = []
    for part in (~late, None, late):
        if part is not None:
            land_feed(t, "delays", paths.raw, part)
        added.append(ingest_incremental(t.spark, "delays", paths, ts=STAMP))
    table = tables.read_processed(t.spark, paths.processed, "delays")
    return table.groupBy("report_date").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.lit(rows).cast("bigint").alias(f"corrida_{i}") for i, rows in enumerate(added, 1)],
    )


register(
    "a11_incremental",
    _a11,
    f"""select report_date, count(*) as n,
          (select count(*) from delays where report_date < date '{HALF}') as corrida_1, 0::bigint as corrida_2,
          (select count(*) from delays where report_date >= date '{HALF}') as corrida_3
        from delays group by 1""",
)
register(
    "a12_audit",
    lambda t: raw.with_ingested_at(t.delays.select("report_date", "incident_id"), STAMP)
    .groupBy("report_date", F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss").alias("cargado"))
    .agg(F.count(F.lit(1)).alias("n")),
    f"select report_date, '{STAMP}' as cargado, count(*) as n from delays group by 1",
)


def _a13(t: BoundTables) -> DataFrame:
    """One feed is broken: the two others are complete and the error names the broken one."""
    base = [scratch_dir(t.spark, x) for x in ("raw", "out", "ck")]
    paths = {feed: FeedPaths.below(feed, *base) for feed in ("flights", "weather", "delays")}
    for feed in ("flights", "delays"):
        land_feed(t, feed, paths[feed].raw)
    # a pull per weather day that breaks off in the middle of a record
    torn = t.weather.select(F.concat(F.lit('{"location": {"name": "'), "city").alias("value"))
    torn.write.text(paths["weather"].raw)
    try:
        reports = run_feeds(t.spark, paths, ts=STAMP)
    except FeedError as failed:
        reports = failed.reports
    flights, weather, delays = (next(r for r in reports if r.feed == f) for f in paths)
    table = tables.read_processed(t.spark, paths["flights"].processed, "flights")
    return table.groupBy("airline_iata").agg(
        F.count(F.lit(1)).alias("n"),
        F.lit(flights.rows).cast("bigint").alias("vuelos"),
        F.lit(weather.error is not None).alias("clima_roto"),
        F.lit(weather.rows).cast("bigint").alias("climas"),
        F.lit(delays.rows).cast("bigint").alias("incidentes"),
    )


register(
    "a13_feed_isolation",
    _a13,
    """select airline_iata, count(*) as n, (select count(*) from flights) as vuelos, true as clima_roto,
         0::bigint as climas, (select count(*) from delays) as incidentes from flights group by 1""",
)


def _torn(t: BoundTables, feed: str, path: str) -> None:
    """Pulls of a feed that break off in the middle of a record, a file per task."""
    head = '{"data": [{"flight_date": "' if feed == "flights" else '[{"title": "'
    t.delays.select(F.concat(F.lit(head), F.col("report_date").cast("string")).alias("value")).distinct().write.text(path)


def _a13_torn(t: BoundTables) -> DataFrame:
    """The feed with the array payload is broken: it says so and adds nothing, and the others are complete."""
    base = [scratch_dir(t.spark, x) for x in ("raw", "out", "ck")]
    paths = {feed: FeedPaths.below(feed, *base) for feed in ("flights", "weather", "delays")}
    _torn(t, "flights", paths["flights"].raw)
    for feed in ("weather", "delays"):
        land_feed(t, feed, paths[feed].raw)
    try:
        reports = run_feeds(t.spark, paths, ts=STAMP)
    except FeedError as failed:
        reports = failed.reports
    flights, weather, delays = (next(r for r in reports if r.feed == f) for f in paths)
    return tables.read_processed(t.spark, paths["delays"].processed, "delays").groupBy("is_resolved").agg(
        F.count(F.lit(1)).alias("n"),
        F.lit(flights.error is not None).alias("vuelos_rotos"),
        F.lit(flights.rows).cast("bigint").alias("vuelos"),
        F.lit(weather.rows).cast("bigint").alias("climas"),
        F.lit(delays.rows).cast("bigint").alias("incidentes"),
    )


register(
    "a13_torn_flights",
    _a13_torn,
    """select is_resolved, count(*) as n, true as vuelos_rotos, 0::bigint as vuelos,
         (select count(*) from weather) as climas, (select count(*) from delays) as incidentes from delays group by 1""",
)


def _a13_quarantine(t: BoundTables) -> DataFrame:
    """Torn documents go aside, the good pulls land, then a batch job and the catalog use the same table."""
    base = [scratch_dir(t.spark, x) for x in ("raw", "out", "ck", "aside")]
    paths = FeedPaths.below("delays", *base)
    late = F.col("report_date") >= F.lit(HALF).cast("date")
    land_feed(t, "delays", paths.raw, ~late)
    _torn(t, "delays", f"{paths.raw}/torn")
    report = run_feeds(t.spark, {"delays": paths}, ts=STAMP)[0]
    aside = t.spark.read.parquet(paths.quarantine).count()
    # a batch writer adds the other half to the table of the stream
    flat = t.delays.where(late).withColumn("ingested_at", F.lit(STAMP).cast("timestamp"))
    tables.write_partitioned(flat, paths.processed, "report_date")
    database = f"vuelos_{uuid.uuid4().hex[:12]}"
    tables.ensure_database(t.spark, database, scratch_dir(t.spark, "db"))
    name = tables.register_table(t.spark, database, "delays", paths.processed, "delays")
    return t.spark.table(name).groupBy("report_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.lit(report.rows).cast("bigint").alias("ingeridas"),
        F.lit(report.quarantined == aside and aside > 0).alias("apartadas"),
    )


register(
    "a13_quarantine",
    _a13_quarantine,
    f"""select report_date, count(*) as n, (select count(*) from delays where report_date < date '{HALF}') as ingeridas,
          true as apartadas from delays group by 1""",
)


def _a14(t: BoundTables) -> DataFrame:
    counts = feed_counts()
    path = scratch_dir(t.spark, "delays")
    tables.write_partitioned(counts.watch("delays", t.delays), path, "report_date")
    written = t.spark.read.parquet(path)
    return written.groupBy("motivo").agg(
        F.count(F.lit(1)).alias("n"), F.lit(counts.rows["delays"]).cast("bigint").alias("contadas")
    )


register(
    "a14_feed_counts",
    _a14,
    """select event_type as motivo, count(*) as n, (select count(*) from delays) as contadas
       from delays join events on event_id = incident_id group by 1""",
)
register(
    "a15_preview",
    lambda t: preview(t.dim_aeropuerto, 10, ["airport_iata", "airport_name"]),
    "select * from dim_aeropuerto order by airport_iata, airport_name limit 10",
)

# --- projections of raw records ---------------------------------------------------------


def _b1(t: BoundTables) -> DataFrame:
    records = raw.explode_data(raw.read_flights_raw(t.spark, _landed(t, "flights")))
    return records.groupBy(F.col("f.departure.iata").alias("salida"), F.col("f.arrival.iata").alias("llegada")).agg(
        F.count(F.lit(1)).alias("n")
    )


register(
    "b1_explode",
    _b1,
    "select departure_iata as salida, arrival_iata as llegada, count(*) as n from flights group by 1, 2",
)
register(
    "b2_flatten",
    lambda t: raw.flatten_weather(raw.read_weather_raw(t.spark, _landed(t, "weather")), STAMP).drop("ingested_at"),
    "select * exclude (oid) replace (local_time || ' 9:05' as local_time) from weather",
)
register(
    "b3_casts",
    lambda t: raw.flatten_delays(raw.read_delays_raw(t.spark, _landed(t, "delays")), ts=STAMP).drop("ingested_at"),
    f"select {_DELAY_COLUMNS} from delays",
)

# --- feeds from JSON to processed tables ------------------------------------------------


def _etl(t: BoundTables, feed: str) -> DataFrame:
    landed = _landed(t, feed)
    flat = raw.flatten(feed, raw.read_raw(t.spark, feed, landed), ts=STAMP)
    path = scratch_dir(t.spark, feed)
    tables.write_partitioned(flat, path, PARTITION[feed])
    return tables.read_processed(t.spark, path, feed).drop("ingested_at")


register(
    "h13_etl_flights", lambda t: _etl(t, "flights"), "select * exclude (origin_city) from flights"
)
register(
    "h14_etl_weather",
    lambda t: _etl(t, "weather"),
    "select * exclude (oid) replace (local_time || ' 9:05' as local_time) from weather",
)
register("h15_etl_delays", lambda t: _etl(t, "delays"), f"select {_DELAY_COLUMNS} from delays")
