"""The daily job: new feed files into processed tables, then models for the dates that changed."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bitmaps import Codes, codes_of, new_codes
from ..session import scratch_dir
from ..sources.releases import Release, publish, published
from ..sources.schemas import PARTITION, PROCESSED
from ..sources.tables import materialize, only, read_processed, replace_dates, write_partitioned
from ..streaming.ingest import FEEDS, Expectation, FeedError, FeedPaths, FeedReport, judged, run_feeds
from . import daily, facts, history, marts, rollups, staging

#: File times and the clock of the driver may differ by this much.
CLOCK_SLACK = timedelta(hours=1)


@dataclass
class RunReport:
    started_at: datetime
    feeds: list[FeedReport] = field(default_factory=list)
    changed: dict[str, list[date] | None] = field(default_factory=dict)


def processed_table(spark: SparkSession, path: str, feed: str) -> tuple[DataFrame, bool]:
    """The table of a feed and whether it exists; a feed that never delivered is an empty table."""
    try:
        return read_processed(spark, path, feed), True
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], PROCESSED[feed]), False


def changed_dates(table: DataFrame, column: str, since: datetime | None) -> list[date] | None:
    """Partition values with files written after ``since``; None means all of them.

    Spark drops the older files while listing, so the history is not read. The list is
    bounded by the calendar: it names partitions, not rows.
    """
    if since is None:
        return None
    stamp = F.lit((since - CLOCK_SLACK).isoformat()).cast("timestamp")
    fresh = table.where(F.col("_metadata.file_modification_time") >= stamp)
    return [row[0] for row in fresh.select(column).distinct().collect() if row[0] is not None]


def dictionary(values: DataFrame, path: str) -> Codes:
    """The dictionary at ``path``, with codes for new values appended."""
    spark, schema = values.sparkSession, "value string, code bigint"
    try:
        known = spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        known = None
    new = materialize(new_codes(values, known), scratch_dir(spark, "codes"))
    if known is None or not new.isEmpty():
        new.write.mode("append").parquet(path)
    return codes_of(spark.read.schema(schema).parquet(path))


def curated_table(spark: SparkSession, curated: str, name: str, release: Release | None = None) -> DataFrame:
    """A table that the daily job wrote: dimensions of the current or the given release, others as they are."""
    if name.startswith("dim_"):
        return published(spark, curated, name, release)
    return spark.read.parquet(f"{curated}/{name}")


def run_models(
    spark: SparkSession,
    processed: str,
    curated: str,
    since: datetime | None = None,
    city: str | None = None,
    cities: DataFrame | None = None,
    cases: DataFrame | None = None,
) -> dict[str, list[date] | None]:
    """Daily tables and rollups of the changed dates, then dimensions and facts from those.

    With ``cities`` (airport_iata, ciudad) the per-flight fact of the dashboard is kept as well, and airports get their
    city. With ``cases`` (incident_id and what the feed does not hold: airline_name, motivo, minutos_retraso_asociado,
    satisfaccion_cliente, tiempo_resolucion_horas) the incident fact is kept.

    Dimensions are published as a set, see ``sources.releases``; ``curated_table`` reads them and the facts by name.
    """
    tables: dict[str, DataFrame] = {}
    changed: dict[str, list[date] | None] = {}
    for feed in FEEDS:
        tables[feed], exists = processed_table(spark, f"{processed}/{feed}", feed)
        changed[feed] = changed_dates(tables[feed], PARTITION[feed], since) if exists or since is None else []
    stg_f = staging.stg_flights(only(tables["flights"], "flight_date", changed["flights"]))
    stg_w = staging.stg_weather(only(tables["weather"], "weather_date", changed["weather"]))
    stg_d = staging.stg_delays(only(tables["delays"], "report_date", changed["delays"]))

    def keep(name: str, fresh: DataFrame, feed: str) -> DataFrame:
        return replace_dates(fresh, f"{curated}/{name}", PARTITION[feed], changed[feed])

    airlines = keep("rollup_aerolinea", rollups.airline_rollup(stg_f), "flights")
    routes = keep("rollup_ruta", rollups.route_rollup(stg_f), "flights")
    # codes come from the rollups of the changed dates, so the records are read once more, for everything per date
    new_routes = only(routes, "flight_date", changed["flights"])
    ends = [new_routes.select(F.col(c).alias("value")) for c in ("departure_iata", "arrival_iata")]
    of_airlines = dictionary(only(airlines, "flight_date", changed["flights"]).select("airline_iata"), f"{curated}/dict_aerolinea")
    of_airports = dictionary(ends[0].unionByName(ends[1]), f"{curated}/dict_aeropuerto")
    codes = {"airline_iata": of_airlines, "departure_iata": of_airports, "arrival_iata": of_airports}
    state = keep("rollup_vuelos", daily.flight_state(stg_f, codes), "flights")
    new_state = only(state, "flight_date", changed["flights"])
    flights_daily = keep("int_flights_daily", daily.flights_daily_from_state(new_state), "flights")
    measured = keep("rollup_clima", rollups.daily_weather_rollup(stg_w), "weather")
    incidents_daily = keep("int_delays_daily", daily.int_delays_daily(stg_d), "delays")

    new_weather = only(measured, "weather_date", changed["weather"])
    weather_daily = keep("int_weather_daily", daily.weather_daily_from_rollup(new_weather), "weather")
    clima = replace_dates(
        facts.clima_diario_from_rollup(new_weather), f"{curated}/fct_clima_diario", "fecha", changed["weather"]
    )

    def years(name: str, days: DataFrame, state: history.Additive, feed: str) -> DataFrame:
        return history.by_year(days, PARTITION[feed], state, f"{curated}/{name}", changed[feed])

    airports = marts.dim_aeropuerto_from_rollup(years("rollup_ruta", routes, history.ROUTES, "flights"))
    dims = {
        "dim_fecha": marts.dim_fecha(flights_daily, weather_daily, incidents_daily),
        "dim_aerolinea": marts.dim_aerolinea_from_rollup(years("rollup_aerolinea", airlines, history.AIRLINES, "flights")),
        "dim_aeropuerto": airports if cities is None else facts.airport_city(airports, cities),
        "dim_condicion_clima": marts.dim_condicion_clima_from_rollup(years("rollup_clima", measured, history.CONDITIONS, "weather")),
    }
    # dimensions are whole tables that belong together, so they change at once
    publish(spark, curated, dims)
    incidents_short = daily.incidents_from_daily(incidents_daily)
    lean = marts.fct_flights_lean(flights_daily, weather_daily, incidents_short, city)
    full = marts.fct_flights_full(flights_daily, weather_daily, incidents_daily, city)
    # facts are replaced by date, so the dates that did not change are served throughout
    touched = None if since is None else sorted({d for days in changed.values() for d in days})
    for name, fact in (("fct_flights_lean", lean), ("fct_flights_analytics", full)):
        replace_dates(marts.with_updated_at(only(fact, "fecha", touched)), f"{curated}/{name}", "fecha", touched)
    if cities is not None:
        dates = None if since is None else sorted({*changed["flights"], *changed["weather"]})
        flights = only(tables["flights"], "flight_date", dates)
        flights = flights.where(F.col("flight_date").isNotNull() & F.col("flight_number").isNotNull())
        placed = flights.join(cities.withColumnRenamed("airport_iata", "departure_iata"), "departure_iata", "left")
        # With the partitions of the other dates pruned, Catalyst knows that the weather is small.
        vuelos = facts.fct_vuelos(placed, only(clima, "fecha", dates), "ciudad")
        # an increment is small and gets compacted; the whole history is written where it was read
        write_partitioned(vuelos, f"{curated}/fct_vuelos", "fecha", "overwrite", balance=since is not None)
    if cases is not None:
        incidents = only(tables["delays"], "report_date", changed["delays"])
        named = incidents.select("incident_id", "report_date", "user_id", "is_resolved").join(cases, "incident_id", "left")
        names = {"incidente_id": "incident_id", "fecha": "report_date", "agente_id": "user_id"}
        replace_dates(facts.fct_incidentes(named, names), f"{curated}/fct_incidentes", "fecha", changed["delays"])
    return changed


def run_daily(
    spark: SparkSession,
    raw: str,
    processed: str,
    curated: str,
    checkpoint: str,
    as_of: date | str | None = None,
    since: datetime | None = None,
    city: str | None = None,
    cities: DataFrame | None = None,
    quarantine: str | None = None,
    cases: DataFrame | None = None,
    expect: Mapping[str, Expectation] | None = None,
) -> RunReport:
    """Ingests all feeds and refreshes the models.

    With ``quarantine`` documents that are no JSON go there, else they fail their feed. With ``expect`` the counts of
    the feeds are judged: a count outside of its bounds is a warning in the report, or an error after the rest is done.

    ``since`` is the ``started_at`` of the last successful run; without it everything is
    computed anew. Every step can be repeated. A broken feed is raised after the rest is done.
    """
    report = RunReport(started_at=datetime.now(timezone.utc))
    paths = {feed: FeedPaths.below(feed, raw, processed, checkpoint, quarantine) for feed in FEEDS}
    failure: FeedError | None = None
    try:
        report.feeds = run_feeds(spark, paths, as_of)
    except FeedError as exc:
        failure, report.feeds = exc, exc.reports
    report.feeds = judged(report.feeds, expect or {})
    if any(r.error for r in report.feeds):
        failure = FeedError(report.feeds)
    report.changed = run_models(spark, processed, curated, since, city, cities, cases)
    if failure is not None:
        raise failure
    return report
