"""Measures, filter contexts, rankings and payloads on hand-made tables."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from vuelometria.operators.groups import mode_per_group
from vuelometria.operators.shape import left_attach
from vuelometria.operators.topn import latest_with_ties, top_with_ties
from vuelometria.operators.totals import running_total
from vuelometria.plans import marts
from vuelometria.plans.binding import BoundTables
from vuelometria.plans.measures import evaluate, measure
from vuelometria.plans.payloads import payload_names, visual_payload
from vuelometria.plans.visuals import visual


@pytest.fixture(scope="module")
def bound(spark, folder):
    return BoundTables(spark, folder)


def test_top_keeps_all_ties_and_drops_null(spark):
    df = spark.createDataFrame([("a", 5), ("b", 4), ("c", 4), ("d", 4), ("e", 1), ("f", None)], "k string, v int")
    assert {r["k"] for r in top_with_ties(df, "v", 2).collect()} == {"a", "b", "c", "d"}
    assert {r["k"] for r in top_with_ties(df, "v", 2, ascending=True).collect()} == {"e", "b", "c", "d"}
    assert {r["k"] for r in top_with_ties(df, "v", 50).collect()} == {"a", "b", "c", "d", "e"}
    assert top_with_ties(df.where("v is null"), "v", 2).count() == 0
    assert {r["k"] for r in latest_with_ties(df, "v", 2).collect()} == {"a", "b", "c", "d"}


def test_top_ignores_the_last_bits_of_doubles(spark):
    df = spark.createDataFrame([("a", 0.3), ("b", 0.1 + 0.2), ("c", 0.2)], "k string, v double")
    assert {r["k"] for r in top_with_ties(df, "v", 1).collect()} == {"a", "b"}


def test_mode_breaks_ties_alphabetically(spark):
    df = spark.createDataFrame([("x", "b"), ("x", "a"), ("x", None), ("x", None), ("y", None)], "k string, v string")
    rows = {r["k"]: (r["v"], r["frecuencia"]) for r in mode_per_group(df, ["k"], "v").collect()}
    assert rows == {"x": ("a", 1), "y": (None, None)}


def test_running_total(spark):
    df = spark.createDataFrame([(2, 5), (1, 3), (3, 1)], "d int, n int")
    assert [r["n_acum"] for r in running_total(df, "d", ["n"]).orderBy("d").collect()] == [3, 8, 9]


def test_attach_keeps_left_rows_and_names(spark):
    left = spark.createDataFrame([(1,), (2,)], "a int")
    right = spark.createDataFrame([(1, "x"), (1, "y")], "b int, t string")
    out = left_attach(left, right, {"a": "b"})
    assert out.columns == ["a", "t"]
    assert sorted((r["a"], r["t"] or "") for r in out.collect()) == [(1, "x"), (1, "y"), (2, "")]


def test_spelling_variants_share_their_metrics(spark):
    day = datetime.date(2026, 4, 1)
    rows = [("U1", "Uno", True, 30), ("U1", "UNO", False, 0), ("U1", None, False, 0), (None, "Nadie", True, 20)]
    stg = spark.createDataFrame(
        [(day, i, n, late, d, "completado") for i, n, late, d in rows],
        "flight_date date, airline_iata string, airline_name string, tiene_retraso boolean, departure_delay_min int, "
        "flight_status string",
    )
    out = marts.dim_aerolinea(stg).collect()
    assert {r["airline_name"] for r in out} == {"Uno", "UNO", None}
    assert {(r["total_vuelos_historico"], r["pct_retraso_historico"], r["confiabilidad"]) for r in out} == {
        (3, 33.33, "baja")
    }


def test_measures_of_nothing(spark, bound):
    empty = bound.facts["fct_vuelos"].where("false")
    row = evaluate(empty, ["total_vuelos", "pct_a_tiempo", "avg_retraso_min", "indice_eficiencia"]).collect()[0]
    assert list(row) == [0, None, None, None]


def test_filter_context_equals_filtered_rows(bound):
    vuelos = bound.facts["fct_vuelos"]
    pred = F.col("destino_iata") == "NATION_3"
    names = ["total_vuelos", "pct_a_tiempo", "avg_retraso_min", "pct_cancelados"]
    inside = vuelos.agg(*[measure(n, where=pred) for n in names]).collect()
    assert inside == evaluate(vuelos, names, where=pred).collect()


def test_slicers_restrict_facts(bound):
    where = {"dim_fecha": F.col("anio") == 1998, "fct_vuelos": F.col("flight_status") != "cancelled"}
    rows = visual("p1_v4_embudo")(bound.facts, bound.dims, where).collect()
    values = {r["etapa"]: r["valor"] for r in rows}
    expected = bound.fct_vuelos.where("year(fecha) = 1998 and flight_status <> 'cancelled'").count()
    assert values["Ejecutados"] == values["Planificados"] == expected and values["Cancelados"] == 0


@pytest.mark.parametrize("name", payload_names())
def test_payload_is_json_with_all_rows(bound, name):
    frame = visual_payload(name)(bound.facts, bound.dims)
    rows = frame.collect()
    if "tipo" in frame.columns:  # a row per line
        assert len(rows) == visual(name)(bound.facts, bound.dims).count() and all(r["tipo"] and r["payload"] for r in rows)
        return
    text = json.loads(rows[0]["payload"])
    assert len(rows) == 1 and text["tipo"]
    lines = text["data"].split("|") if text["data"] else []
    expected = 2 if name == "p3_v1_cierre" else visual(name)(bound.facts, bound.dims).count()
    assert len(lines) == expected


# --- properties of the models -----------------------------------------------------------


def test_daily_flight_counts_add_up(bound):
    days = bound.int_flights_daily
    states = "vuelos_completados + vuelos_cancelados + vuelos_programados + vuelos_en_vuelo"
    assert days.where(f"{states} > total_vuelos").count() == 0
    assert days.where("retrasos_moderados + retrasos_severos + retrasos_criticos <> vuelos_con_retraso").count() == 0
    assert days.where("not (pct_vuelos_con_retraso between 0 and 100)").count() == 0


def test_airport_movements_add_up(bound):
    airports = bound.dim_aeropuerto
    assert airports.where("vuelos_como_origen + vuelos_como_destino <> total_movimientos").count() == 0
    total = airports.agg(F.sum("total_movimientos")).collect()[0][0]
    assert total == 2 * bound.stg_flights.count()


def test_fact_rows_per_date(bound):
    args = (bound.int_flights_daily, bound.int_weather_daily, bound.int_delays_daily)
    cities = bound.int_weather_daily.groupBy(F.col("weather_date").alias("fecha")).agg(F.count("city").alias("cities"))
    fanned = marts.fct_flights_full(*args).groupBy("fecha").agg(F.count("*").alias("rows"))
    wrong = fanned.join(cities, "fecha", "left").where("rows <> greatest(coalesce(cities, 0), 1)")
    assert wrong.count() == 0
    one_city = marts.fct_flights_full(*args, city="ASIA")
    assert one_city.count() == one_city.select("fecha").distinct().count() == bound.int_flights_daily.count()


def test_star_keys(bound):
    """The calendar is unique; duplicate airline codes can only come from spelling variants."""
    assert bound.dim_fecha.count() == bound.dim_fecha.select("fecha").distinct().count()
    airlines = bound.dim_aerolinea
    assert airlines.count() == airlines.select("airline_iata", "airline_name").distinct().count()
    assert airlines.groupBy("airline_iata").count().where("count > 1").count() == 0


def test_approximate_diversity_is_close(bound):
    from vuelometria.plans.daily import flight_diversity

    exact = flight_diversity(bound.stg_flights).agg(F.sum("num_aerolineas")).collect()[0][0]
    approx = flight_diversity(bound.stg_flights, approx=True).agg(F.sum("num_aerolineas")).collect()[0][0]
    assert abs(exact - approx) <= 0.1 * exact


def test_short_incidents_follow_from_the_daily_table(bound):
    from vuelometria.plans.daily import incidents_from_daily

    direct = bound.incidents_per_day
    derived = incidents_from_daily(bound.int_delays_daily).select(direct.columns)
    assert sorted(derived.collect()) == sorted(direct.collect())


def test_dimensions_follow_from_dated_rollups(bound):
    from vuelometria.plans import facts, rollups
    from vuelometria.plans.daily import weather_daily_from_rollup

    airlines = marts.dim_aerolinea_from_rollup(rollups.airline_rollup(bound.stg_flights))
    assert sorted(airlines.collect()) == sorted(bound.dim_aerolinea.collect())
    airports = marts.dim_aeropuerto_from_rollup(rollups.route_rollup(bound.stg_flights))
    assert sorted(airports.collect()) == sorted(bound.dim_aeropuerto.collect())
    measured = rollups.daily_weather_rollup(bound.stg_weather)
    conditions = marts.dim_condicion_clima_from_rollup(measured)
    assert sorted(conditions.collect()) == sorted(bound.dim_condicion_clima.collect())
    assert weather_daily_from_rollup(measured).count() == bound.int_weather_daily.count()
    assert facts.clima_diario_from_rollup(measured).count() == bound.fct_clima_diario.count()
