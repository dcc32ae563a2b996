"""Star schema: calendar, airline, airport and weather-condition dimensions, daily fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar, rules
from ..functions.numeric import coalesce0, pct, ratio, round_n
from ..functions.text import CONDITION_DEFAULT, CONDITION_KEYWORDS, classify_text
from ..operators.shape import left_attach
from .rollups import airline_rollup, mean_of, route_rollup, weather_rollup


# --- calendar ---------------------------------------------------------------------------


def distinct_dates(*sources: tuple[DataFrame, str]) -> DataFrame:
    """Union of the dates found in (frame, date column) pairs.

    Any frame with all the dates will do: staged records, or the far smaller daily tables.
    """
    frames = [df.select(F.col(column).alias("fecha")).distinct() for df, column in sources]
    out = frames[0]
    for other in frames[1:]:
        out = out.union(other)
    return out.distinct()


def dim_fecha(flights: DataFrame, weather: DataFrame, delays: DataFrame, ordered: bool = True) -> DataFrame:
    dates = distinct_dates((flights, "flight_date"), (weather, "weather_date"), (delays, "report_date"))
    out = dates.select("fecha", *calendar.calendar_columns("fecha"))
    return out.orderBy("fecha") if ordered else out


# --- airlines ---------------------------------------------------------------------------


def airline_metrics(rollup: DataFrame) -> DataFrame:
    """Per airline code, all spellings together."""
    total, late = F.sum("vuelos"), F.sum("retrasos")
    return rollup.groupBy("airline_iata").agg(
        total.alias("total_vuelos_historico"),
        late.alias("total_retrasos_historico"),
        pct(late, total).alias("pct_retraso_historico"),
        round_n(ratio(F.sum("minutos"), total), 1).alias("avg_retraso_historico_min"),
        F.sum("cancelados").alias("total_cancelaciones"),
        F.min("primera").alias("primera_operacion"),
        F.max("ultima").alias("ultima_operacion"),
    )


def dim_aerolinea_from_rollup(rollup: DataFrame) -> DataFrame:
    """One row per (code, spelling); the metrics are those of the code.

    The rollup is folded to one row per spelling, then a window by code adds the spellings
    up: one pass over the input instead of a distinct list joined with a second aggregate.
    """
    folded = rollup.groupBy("airline_iata", "airline_name").agg(
        *[F.sum(c).alias(c) for c in ("vuelos", "retrasos", "cancelados", "minutos")],
        F.min("primera").alias("primera"),
        F.max("ultima").alias("ultima"),
    )
    code = Window.partitionBy("airline_iata")
    total, late = F.sum("vuelos").over(code), F.sum("retrasos").over(code)
    return folded.select(
        "airline_iata",
        "airline_name",
        total.alias("total_vuelos_historico"),
        late.alias("total_retrasos_historico"),
        pct(late, total).alias("pct_retraso_historico"),
        round_n(ratio(F.sum("minutos").over(code), total), 1).alias("avg_retraso_historico_min"),
        F.sum("cancelados").over(code).alias("total_cancelaciones"),
        F.min("primera").over(code).alias("primera_operacion"),
        F.max("ultima").over(code).alias("ultima_operacion"),
    ).withColumn("confiabilidad", rules.reliability("pct_retraso_historico"))


def dim_aerolinea(stg_flights: DataFrame) -> DataFrame:
    return dim_aerolinea_from_rollup(airline_rollup(stg_flights, by_date=False))


# --- airports ---------------------------------------------------------------------------


def airport_ends(rollup: DataFrame) -> DataFrame:
    """Each route row once as origin and once as destination."""
    def end(iata: str, name: str, as_origin: bool) -> Column:
        zero = F.lit(0).cast("bigint")
        used, unused = (F.col("vuelos"), F.col("retrasos")), (zero, zero)
        origin, destination = (used, unused) if as_origin else (unused, used)
        return F.struct(
            F.col(iata).alias("airport_iata"),
            F.col(name).alias("airport_name"),
            origin[0].alias("salidas"),
            origin[1].alias("salidas_tarde"),
            destination[0].alias("llegadas"),
            destination[1].alias("llegadas_tarde"),
        )

    ends = F.array(
        end("departure_iata", "departure_airport", True), end("arrival_iata", "arrival_airport", False)
    )
    return rollup.select(F.inline(ends)).where(F.col("airport_iata").isNotNull())


def dim_aeropuerto_from_rollup(rollup: DataFrame) -> DataFrame:
    """One row per (code, spelling) seen at either end of a flight; metrics are those of the code."""
    sums = ("salidas", "salidas_tarde", "llegadas", "llegadas_tarde")
    folded = airport_ends(rollup).groupBy("airport_iata", "airport_name").agg(*[F.sum(c).alias(c) for c in sums])
    code = Window.partitionBy("airport_iata")
    salidas, tarde, llegadas, llegadas_tarde = [F.sum(c).over(code) for c in sums]
    return folded.select(
        "airport_iata",
        "airport_name",
        salidas.alias("vuelos_como_origen"),
        llegadas.alias("vuelos_como_destino"),
        (salidas + llegadas).alias("total_movimientos"),
        coalesce0(pct(tarde, salidas)).alias("pct_retraso_como_origen"),
        coalesce0(pct(llegadas_tarde, llegadas)).alias("pct_retraso_como_destino"),
    )


def dim_aeropuerto(stg_flights: DataFrame) -> DataFrame:
    return dim_aeropuerto_from_rollup(route_rollup(stg_flights, by_date=False))


# --- weather conditions -----------------------------------------------------------------


def condition_metrics(rollup: DataFrame) -> DataFrame:
    """Per condition text (NULL is a group here)."""
    return rollup.groupBy("condition").agg(
        F.sum("mediciones").alias("frecuencia"),
        round_n(mean_of("visibility_km"), 1).alias("avg_visibility_km"),
        round_n(mean_of("wind_kph"), 1).alias("avg_wind_kph"),
        round_n(mean_of("chance_of_rain"), 0).alias("avg_chance_of_rain"),
        round_n(mean_of("temp_c"), 1).alias("avg_temp_c"),
        F.max("adversas").alias("genera_condiciones_adversas"),
    )


def dim_condicion_clima_from_rollup(rollup: DataFrame) -> DataFrame:
    """The group rows of the metrics are the distinct texts, so no join is needed."""
    return (
        condition_metrics(rollup.where(F.col("condition").isNotNull()))
        .withColumnRenamed("condition", "condicion_texto")
        .withColumns(
            {
                "impacto_operativo": rules.impact_level(
                    "genera_condiciones_adversas", "avg_chance_of_rain", "avg_visibility_km"
                ),
                "grupo_condicion": classify_text("condicion_texto", CONDITION_KEYWORDS, CONDITION_DEFAULT),
            }
        )
    )


def dim_condicion_clima(stg_weather: DataFrame) -> DataFrame:
    return dim_condicion_clima_from_rollup(weather_rollup(stg_weather, ["condition"]))


# --- daily fact -------------------------------------------------------------------------

_FLIGHTS_LEAN = (
    "total_vuelos", "vuelos_completados", "vuelos_cancelados", "vuelos_con_retraso", "pct_vuelos_con_retraso",
    "avg_retraso_salida_min", "avg_retraso_llegada_min", "max_retraso_salida_min", "num_aerolineas",
)
_FLIGHTS_FULL = (
    "total_vuelos", "vuelos_completados", "vuelos_cancelados", "vuelos_programados", "vuelos_en_vuelo",
    "vuelos_con_retraso", "pct_vuelos_con_retraso", "pct_vuelos_completados", "avg_retraso_salida_min",
    "avg_retraso_llegada_min", "max_retraso_salida_min", "retrasos_menores", "retrasos_moderados",
    "retrasos_severos", "retrasos_criticos", "num_aerolineas", "num_aeropuertos_origen", "num_aeropuertos_destino",
)
_WEATHER_LEAN = (
    "avg_temp_c", "avg_humidity", "avg_wind_kph", "avg_visibility_km", "avg_chance_of_rain", "max_precip_mm",
    "hubo_condiciones_adversas", "condicion_predominante", "visibilidad_categoria", "viento_categoria",
    "temperatura_categoria",
)
_WEATHER_FULL = (
    "avg_temp_c", "avg_temp_f", "avg_humidity", "avg_wind_kph", "avg_visibility_km", "avg_chance_of_rain",
    "avg_pressure_mb", "max_temp_c", "min_temp_c", "max_wind_kph", "max_precip_mm", "hubo_condiciones_adversas",
    "visibilidad_categoria", "viento_categoria", "temperatura_categoria",
)
_INCIDENTS_LEAN = ("total_incidentes", "incidentes_resueltos", "incidentes_alta_prioridad")
_INCIDENTS_FULL = (
    "total_incidentes", "incidentes_resueltos", "incidentes_pendientes", "incidentes_alta_prioridad",
    "incidentes_media_prioridad", "incidentes_baja_prioridad",
)


def join_daily(
    flights_daily: DataFrame, weather_daily: DataFrame, incidents_daily: DataFrame, city: str | None = None
) -> DataFrame:
    """Daily flights with the weather and the incidents of the date.

    Weather has one row per city: without ``city`` a date appears once per city, with it once.
    All inputs are daily tables; the flight side keeps its hash partitioning by date.
    """
    weather = weather_daily.where(F.col("city") == city) if city else weather_daily
    with_weather = left_attach(flights_daily, weather, {"flight_date": "weather_date"})
    return left_attach(with_weather, incidents_daily, {"flight_date": "report_date"})


def _date_parts() -> list[Column]:
    d = F.col("flight_date")
    return [
        F.year(d).alias("anio"), F.month(d).alias("mes"), F.dayofmonth(d).alias("dia"),
        F.dayofweek(d).alias("dia_semana"),
    ]


def _zero_filled(columns: tuple[str, ...]) -> list[Column]:
    return [coalesce0(c).alias(c) for c in columns]


def fct_flights_lean(
    flights_daily: DataFrame, weather_daily: DataFrame, incidents_daily: DataFrame, city: str | None = None
) -> DataFrame:
    """Short daily fact; ``incidents_daily`` is ``incidents_per_day``."""
    return join_daily(flights_daily, weather_daily, incidents_daily, city).select(
        F.col("flight_date").alias("fecha"),
        *_date_parts(),
        *_FLIGHTS_LEAN,
        *_WEATHER_LEAN,
        *_zero_filled(_INCIDENTS_LEAN),
        coalesce0("pct_resolucion").alias("pct_resolucion_incidentes"),
        rules.critical_day(form="lean").alias("dia_critico"),
    )


def fct_flights_full(
    flights_daily: DataFrame, weather_daily: DataFrame, incidents_daily: DataFrame, city: str | None = None
) -> DataFrame:
    """Long daily fact with score and flags; ``incidents_daily`` is ``int_delays_daily``."""
    d = F.col("flight_date")
    return join_daily(flights_daily, weather_daily, incidents_daily, city).select(
        d.alias("fecha"),
        F.col("city").alias("ciudad_clima"),
        F.col("condicion_predominante").alias("condicion_clima"),
        *_date_parts(),
        calendar.weekday_name(d).alias("nombre_dia"),
        calendar.is_weekend(d).alias("es_fin_de_semana"),
        *_FLIGHTS_FULL,
        *_WEATHER_FULL,
        F.col("num_mediciones").alias("mediciones_clima"),
        *_zero_filled(_INCIDENTS_FULL),
        coalesce0("pct_resolucion").alias("pct_resolucion_incidentes"),
        coalesce0("pct_criticos_sin_resolver").alias("pct_criticos_sin_resolver"),
        coalesce0("num_agentes_activos").alias("num_agentes_activos"),
        rules.critical_day(form="full").alias("dia_critico"),
        rules.performance_score("pct_vuelos_completados", "pct_vuelos_con_retraso", "pct_resolucion").alias(
            "score_rendimiento"
        ),
        rules.weather_impact("hubo_condiciones_adversas", "pct_vuelos_con_retraso").alias("clima_impacto_operaciones"),
    )


def with_updated_at(fact: DataFrame) -> DataFrame:
    return fact.withColumn("dbt_updated_at", F.current_timestamp())
