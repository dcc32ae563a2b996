"""Dimensions from a tree of days, months and years."""

import datetime
import glob
import os

from pyspark.sql import functions as F

from vuelometria.plans import history, marts
from vuelometria.plans.daily_run import curated_table, run_daily
from vuelometria.sources.tables import write_partitioned

from test_ingest import FLIGHT, INCIDENT, WEATHER, flight, put

ROUTE = "departure_iata string, departure_airport string, arrival_iata string, arrival_airport string"


def spoil(pattern):
    """Makes files unreadable; a query that opens one fails."""
    found = glob.glob(pattern)
    for path in found:
        with open(path, "wb") as file:
            file.write(b"no parquet")
    return len(found)


def days_of(spark, first, n, flights=1, step=1):
    rows = [(first + datetime.timedelta(days=step * i), "AAA", "A", "BBB", None, flights, i % 2) for i in range(n)]
    return spark.createDataFrame(rows, f"flight_date date, {ROUTE}, vuelos bigint, retrasos bigint")


def test_a_changed_date_opens_its_month_and_its_year_only(spark, tmp_path):
    days, root = str(tmp_path / "days"), str(tmp_path / "tree")
    write_partitioned(days_of(spark, datetime.date(2023, 12, 25), 63, step=7), days, "flight_date")
    table = spark.read.parquet(days)
    assert history.by_year(table, "flight_date", history.ROUTES, root, None).count() == 3
    changed = datetime.date(2024, 3, 4)
    write_partitioned(days_of(spark, changed, 1, flights=100), days, "flight_date", mode="overwrite")
    flat = sorted(marts.dim_aeropuerto_from_rollup(spark.read.parquet(days)).collect())
    gone = [d for d in os.listdir(days) if d.startswith("flight_date=") and not d.startswith("flight_date=2024-03")]
    assert sum(spoil(f"{days}/{d}/*.parquet") for d in gone) == 59
    assert sum(spoil(f"{root}_mes/mes={y}-*/*.parquet") for y in (2023, 2025)) == 4
    years = history.by_year(spark.read.schema(table.schema).parquet(days), "flight_date", history.ROUTES, root, [changed])
    assert sorted(marts.dim_aeropuerto_from_rollup(years).collect()) == flat
    assert {r["anio"]: r["vuelos"] for r in years.collect()} == {2023: 1, 2024: 53 + 99, 2025: 9}
    # no date changed: nothing but the years is read
    spoil(f"{days}/*/*.parquet"), spoil(f"{root}_mes/*/*.parquet")
    assert history.by_year(spark.read.schema(table.schema).parquet(days), "flight_date", history.ROUTES, root, []).count() == 3


def test_a_tree_that_is_not_there_is_built_whole_and_a_dead_run_is_mended(spark, tmp_path):
    root = str(tmp_path / "tree")
    days = days_of(spark, datetime.date(2024, 1, 30), 5)
    some = [datetime.date(2024, 2, 1)]
    years = history.by_year(days, "flight_date", history.ROUTES, root, some)
    assert years.agg(F.sum("vuelos")).first()[0] == 5
    # the run died between months and years; the next one with the same dates ends in the right sums
    more = days_of(spark, datetime.date(2024, 1, 30), 5, flights=3).where("flight_date = '2024-02-01'")
    days = days.where("flight_date <> '2024-02-01'").unionByName(more)
    for _ in range(2):
        years = history.by_year(days, "flight_date", history.ROUTES, root, some)
    assert years.agg(F.sum("vuelos")).first()[0] == 7
    empty = history.by_year(days.where("false"), "flight_date", history.ROUTES, str(tmp_path / "none"), [])
    assert empty.collect() == []


def test_the_daily_job_keeps_dimensions_over_all_history(spark, tmp_path):
    where = [str(tmp_path / d) for d in ("raw", "out", "curated", "ck")]
    old = [flight(flight_date=f"{y}-0{m}-01", airline={"name": "Viejo", "iata": "V1"}) for y in (2024, 2025) for m in (1, 2, 3)]
    put(tmp_path, "flights", "f1.json", {"data": [FLIGHT, *old]})
    put(tmp_path, "weather", "w1.json", WEATHER)
    put(tmp_path, "delays", "delays_2026-04-01_17-00-00.json", [INCIDENT])
    first = run_daily(spark, *where)
    assert spoil(f"{where[2]}/rollup_aerolinea/flight_date=202[45]*/*.parquet") == 6
    assert spoil(f"{where[2]}/rollup_aerolinea_mes/mes=202[45]*/*.parquet") == 6
    put(tmp_path, "flights", "f2.json", {"data": [flight(flight_date="2026-04-02", airline={"name": "Viejo", "iata": "V1"})]})
    run_daily(spark, *where, since=first.started_at)
    got = {r["airline_iata"]: r for r in curated_table(spark, where[2], "dim_aerolinea").collect()}["V1"]
    assert got["total_vuelos_historico"] == len(old) + 1 and str(got["primera_operacion"]) == "2024-01-01"
