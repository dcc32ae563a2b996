"""Daily aggregates of flights, weather and incidents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import count_where, pct, ratio, round_n
from ..operators.bitmaps import Codes, daily_state, distinct_over
from ..operators.groups import mode_per_group
from .rollups import WEATHER_CLASSES, WEATHER_MEANS, class_label, daily_weather_rollup, mean_of


def _distinct(column: str, approx: bool) -> Column:
    return F.approx_count_distinct(column) if approx else F.count_distinct(F.col(column))


def flight_volumes(stg_flights: DataFrame) -> DataFrame:
    """The additive part of the daily flight table: one pass, one hash aggregation."""
    status, severity = F.col("flight_status"), F.col("severidad_retraso")
    late, done = count_where(F.col("tiene_retraso")), count_where(status == "completado")
    total = F.count(F.lit(1))
    return stg_flights.groupBy("flight_date").agg(
        total.alias("total_vuelos"),
        done.alias("vuelos_completados"),
        count_where(status == "cancelado").alias("vuelos_cancelados"),
        count_where(status == "programado").alias("vuelos_programados"),
        count_where(status == "en_vuelo").alias("vuelos_en_vuelo"),
        late.alias("vuelos_con_retraso"),
        pct(late, total).alias("pct_vuelos_con_retraso"),
        round_n(F.avg("departure_delay_min"), 1).alias("avg_retraso_salida_min"),
        round_n(F.avg("arrival_delay_min"), 1).alias("avg_retraso_llegada_min"),
        F.max("departure_delay_min").alias("max_retraso_salida_min"),
        count_where(severity == "menor").alias("retrasos_menores"),
        count_where(severity == "moderado").alias("retrasos_moderados"),
        count_where(severity == "severo").alias("retrasos_severos"),
        count_where(severity == "critico").alias("retrasos_criticos"),
        pct(done, total).alias("pct_vuelos_completados"),
    )


def flight_diversity(stg_flights: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct airlines, origins and destinations per date; ``approx`` uses sketches."""
    return stg_flights.groupBy("flight_date").agg(
        _distinct("airline_iata", approx).alias("num_aerolineas"),
        _distinct("departure_iata", approx).alias("num_aeropuertos_origen"),
        _distinct("arrival_iata", approx).alias("num_aeropuertos_destino"),
    )


#: columns with codes that are counted per date, and the names of their counts
FLIGHT_CODES = {
    "airline_iata": "num_aerolineas", "departure_iata": "num_aeropuertos_origen", "arrival_iata": "num_aeropuertos_destino",
}


def flight_state(stg_flights: DataFrame, codes: Mapping[str, Codes]) -> DataFrame:
    """All of the daily flight table that can be added up, and bitmaps of its codes, in one pass over the records.

    ``codes`` has a dictionary for each of ``FLIGHT_CODES``.
    """
    status, severity = F.col("flight_status"), F.col("severidad_retraso")
    additive = {
        "total_vuelos": F.count(F.lit(1)),
        **{f"vuelos_{n}": count_where(status == s) for n, s in (
            ("completados", "completado"), ("cancelados", "cancelado"), ("programados", "programado"), ("en_vuelo", "en_vuelo")
        )},
        "vuelos_con_retraso": count_where(F.col("tiene_retraso")),
        **{f"retrasos_{n}": count_where(severity == s) for n, s in (
            ("menores", "menor"), ("moderados", "moderado"), ("severos", "severo"), ("criticos", "critico")
        )},
        **{f"{a}_{n}": f(f"{n}_delay_min") for n in ("departure", "arrival") for a, f in (("sum", F.sum), ("num", F.count))},
        "max_retraso_salida_min": F.max("departure_delay_min"),
    }
    return daily_state(stg_flights, ["flight_date"], {c: codes[c] for c in FLIGHT_CODES}, additive)


def flights_daily_from_state(state: DataFrame) -> DataFrame:
    """The daily flight table from :func:`flight_state`; without a shuffle while a dictionary fits in one bitmap."""
    counts = ("total_vuelos", "vuelos_completados", "vuelos_cancelados", "vuelos_programados", "vuelos_en_vuelo", "vuelos_con_retraso",
              "retrasos_menores", "retrasos_moderados", "retrasos_severos", "retrasos_criticos")
    sums = [F.sum(c).alias(c) for c in counts]
    means = [
        round_n(ratio(F.sum(f"sum_{n}"), F.sum(f"num_{n}")), 1).alias(alias)
        for n, alias in (("departure", "avg_retraso_salida_min"), ("arrival", "avg_retraso_llegada_min"))
    ]
    single = not any(c.startswith("bucket_") for c in state.columns)
    distinct = [F.bitmap_count(F.bitmap_or_agg(f"bitmap_{c}")).alias(name) for c, name in FLIGHT_CODES.items()] if single else []
    volumes = state.groupBy("flight_date").agg(
        *sums, *means, F.max("max_retraso_salida_min").alias("max_retraso_salida_min"), *distinct
    ).withColumns({
        "pct_vuelos_con_retraso": pct("vuelos_con_retraso", "total_vuelos"),
        "pct_vuelos_completados": pct("vuelos_completados", "total_vuelos"),
    })
    return volumes if single else volumes.join(distinct_over(state, ["flight_date"], FLIGHT_CODES), "flight_date")


def int_flights_daily(stg_flights: DataFrame, approx: bool = False, codes: Mapping[str, Codes] | None = None) -> DataFrame:
    """One row per date. With dictionaries of the codes the records are read once, see :func:`flight_state`.

    Without them, Spark repeats every row once per distinct count, along with the input of all other
    aggregates in the same ``agg``. Kept apart, only the three narrow code columns are
    repeated; both halves end up partitioned by date, so joining them needs no shuffle.
    """
    if codes is not None:
        return flights_daily_from_state(flight_state(stg_flights, codes))
    return flight_volumes(stg_flights).join(flight_diversity(stg_flights, approx), "flight_date")


def weather_daily_from_rollup(rollup: DataFrame) -> DataFrame:
    """Second step over (date, city, country, condition) rows; here the text maximum is cheap."""
    return rollup.groupBy("weather_date", "city", "country").agg(
        *[
            round_n(mean_of(c), digits).alias(f"avg_{c}")
            for c, digits in WEATHER_MEANS.items()
            if c != "cloud_coverage"
        ],
        F.max("max_temp_c").alias("max_temp_c"),
        F.min("min_temp_c").alias("min_temp_c"),
        F.max("max_wind_kph").alias("max_wind_kph"),
        F.max("max_precip_mm").alias("max_precip_mm"),
        F.max("max_cloud_coverage").alias("max_cloud_coverage"),
        F.max("condition").alias("condicion_predominante"),
        F.max("adversas").alias("hubo_condiciones_adversas"),
        *[class_label(c, F.max(f"rank_{c}")).alias(c) for c in WEATHER_CLASSES],
        F.sum("mediciones").alias("num_mediciones"),
    )


def int_weather_daily(stg_weather: DataFrame) -> DataFrame:
    """One row per date, city and country. "Predominant" is the alphabetically last text."""
    return weather_daily_from_rollup(daily_weather_rollup(stg_weather))


def weather_daily_mode(stg_weather: DataFrame) -> DataFrame:
    """The condition that was measured most often per date, city and country."""
    return mode_per_group(stg_weather, ["weather_date", "city", "country"], "condition")


def int_delays_daily(stg_delays: DataFrame, approx: bool = False) -> DataFrame:
    """One row per date; with ``approx`` the agents are counted by a sketch."""
    resolved, priority = F.col("is_resolved"), F.col("prioridad")
    total, closed, high = F.count(F.lit(1)), count_where(resolved), count_where(priority == "alta")
    return stg_delays.groupBy("report_date").agg(
        total.alias("total_incidentes"),
        closed.alias("incidentes_resueltos"),
        count_where(~resolved).alias("incidentes_pendientes"),
        high.alias("incidentes_alta_prioridad"),
        count_where(priority == "media").alias("incidentes_media_prioridad"),
        count_where(priority == "baja").alias("incidentes_baja_prioridad"),
        pct(closed, total).alias("pct_resolucion"),
        pct(count_where((priority == "alta") & ~resolved), high).alias("pct_criticos_sin_resolver"),
        _distinct("user_id", approx).alias("num_agentes_activos"),
    )


def incidents_per_day(stg_delays: DataFrame) -> DataFrame:
    """The short incident aggregate of the lean fact; its percentage is not rounded."""
    total, closed = F.count(F.lit(1)), count_where(F.col("is_resolved"))
    return stg_delays.groupBy("report_date").agg(
        total.alias("total_incidentes"),
        closed.alias("incidentes_resueltos"),
        count_where(F.col("prioridad") == "alta").alias("incidentes_alta_prioridad"),
        pct(closed, total, digits=None).alias("pct_resolucion"),
    )


def incidents_from_daily(incidents_daily: DataFrame) -> DataFrame:
    """:func:`incidents_per_day` out of the full daily table."""
    counts = ("total_incidentes", "incidentes_resueltos", "incidentes_alta_prioridad")
    share = pct("incidentes_resueltos", "total_incidentes", digits=None)
    return incidents_daily.select("report_date", *counts, share.alias("pct_resolucion"))
