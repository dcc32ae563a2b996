"""The dashboard queries: three pages of visuals over the star schema.

A visual is called as ``visual(name)(facts, dims, where)``. ``facts`` holds ``fct_vuelos``,
``fct_incidentes`` and ``fct_clima_diario``, ``dims`` holds ``dim_fecha`` and
``dim_aeropuerto``; ``where`` maps table names to the predicates of the slicers. Everything
is grouped first; joins and rankings only see the grouped rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import count_where, ratio, round_n
from ..operators.groups import correlation_pairs, rows_of
from ..operators.shape import drill_across, left_attach
from ..operators.topn import latest_with_ties, top_with_ties
from ..operators.totals import control_limits, running_total, sum_of_groups
from .measures import evaluate, measure

Tables = Mapping[str, DataFrame]
VISUALS: dict[str, Callable[..., DataFrame]] = {}

# The destinations the dashboard looks at, and the targets of its KPIs.
KEY_DESTINATIONS = ("BOG", "MDE", "CLO", "CTG", "MIA")
CLOSURE_TARGET = 80
KPI_TARGETS = {
    "TasaCierre": 80.0,
    "TiempoRes": 20.0,
    "Satisfaccion": 4.0,
    "CasosCerrados": 20000.0,
    "MinEvitados": 40000.0,
}
CORRELATED = {
    "Retraso": "retraso", "Temp": "temp", "Humedad": "humedad", "Nubosidad": "nubosidad", "Viento": "viento",
    "Lluvia": "lluvia",
}


class FilteredTables(Mapping):
    """All tables under the slicer predicates; a predicate on ``dim_fecha`` also restricts the facts.

    A table is only looked up when a visual asks for it.
    """

    def __init__(self, facts: Tables, dims: Tables, where: Mapping[str, Column] | None = None):
        self._facts, self._dims, self._where = facts, dims, where or {}

    def __getitem__(self, name: str) -> DataFrame:
        df = self._facts[name] if name in self._facts else self._dims[name]
        if name in self._where:
            df = df.where(self._where[name])
        if name in self._facts and "dim_fecha" in self._where:
            df = df.join(self["dim_fecha"].select("fecha"), "fecha", "left_semi")
        return df

    def __iter__(self):
        return iter([*self._facts, *self._dims])

    def __len__(self) -> int:
        return len(self._facts) + len(self._dims)

    def __contains__(self, name: object) -> bool:
        return name in self._facts or name in self._dims


def _visual(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    def run(facts: Tables, dims: Tables, where: Mapping[str, Column] | None = None, **options) -> DataFrame:
        return query(FilteredTables(facts, dims, where), **options)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    VISUALS[query.__name__] = run
    return run


def visual(name: str) -> Callable[..., DataFrame]:
    return VISUALS[name]


def _avg_delay(alias: str = "avg_ret") -> Column:
    return round_n(measure("avg_retraso_min"), 6).alias(alias)


def _percent(num: Column | str, den: Column | str) -> Column:
    return round_n(ratio(num, den) * 100, 6)


def _dated(t: Tables, daily: DataFrame) -> DataFrame:
    """Daily rows with the display text of the calendar, restricted to its dates."""
    axis = t["dim_fecha"].select("fecha", "fecha_display")
    return axis.join(daily, "fecha", "inner")


# --- page 1: control tower --------------------------------------------------------------


@_visual
def p1_v1_rutas(t: Tables, n: int = 30) -> DataFrame:
    """Flights per route, the ``n`` busiest."""
    routes = t["fct_vuelos"].groupBy("origen_iata", "destino_iata").agg(F.count(F.lit(1)).alias("vuelos"))
    return top_with_ties(routes, "vuelos", n)


@_visual
def p1_v2_aerolineas_retraso(t: Tables, n: int = 10) -> DataFrame:
    """Airlines with the highest mean delay; those without a known delay come last."""
    return top_with_ties(t["fct_vuelos"].groupBy("airline_name").agg(_avg_delay()), "avg_ret", n, keep_null=True)


def _punctuality(t: Tables) -> DataFrame:
    return t["fct_vuelos"].groupBy("airline_name").agg(
        measure("total_vuelos").alias("n"),
        measure("vuelos_a_tiempo").alias("a_tiempo"),
        count_where(F.col("tiene_retraso")).alias("tarde"),
        measure("total_cancelados").alias("cancelados"),
    )


@_visual
def p1_v3_barra_apilada(t: Tables) -> DataFrame:
    """On-time, late and cancelled shares per airline; late is what the other two leave."""
    rest = F.greatest(F.lit(0.0), 1 - ratio("a_tiempo", "n") - ratio("cancelados", "n"))
    return _punctuality(t).select(
        "airline_name",
        _percent("a_tiempo", "n").alias("pct_t"),
        round_n(rest * 100, 6).alias("pct_r"),
        _percent("cancelados", "n").alias("pct_c"),
    )


@_visual
def p1_v4_embudo(t: Tables) -> DataFrame:
    """Planned, run, on time, cancelled. Planned adds the cancelled share on top of the run flights."""
    row = evaluate(t["fct_vuelos"], ["total_vuelos", "vuelos_a_tiempo", "total_cancelados", "pct_cancelados"])
    share = F.when(F.col("pct_cancelados") >= 1, F.lit(0.999)).otherwise(F.col("pct_cancelados"))
    stages = {
        "Planificados": ratio("total_vuelos", 1 - share),
        "Ejecutados": F.col("total_vuelos"),
        "Completados": F.col("vuelos_a_tiempo"),
        "Cancelados": F.col("total_cancelados"),
    }
    return rows_of(
        row,
        [
            {"orden": F.lit(i), "etapa": F.lit(name), "valor": round_n(value.cast("double"), 6)}
            for i, (name, value) in enumerate(stages.items(), 1)
        ],
    )


@_visual
def p1_v5_destinos(t: Tables, n: int = 15) -> DataFrame:
    """Busiest destinations and their share of all flights."""
    groups = t["fct_vuelos"].groupBy("destino_iata").agg(F.count(F.lit(1)).alias("vuelos"))
    share = _percent(F.col("vuelos"), sum_of_groups(groups, "vuelos"))
    return top_with_ties(groups, "vuelos", n).withColumn("pct", share)


@_visual
def p1_v6_destino_aerolinea(t: Tables, destinations: Sequence[str] = KEY_DESTINATIONS) -> DataFrame:
    """Mean delay per key destination and airline."""
    rows = t["fct_vuelos"].where(F.col("destino_iata").isin(*destinations))
    return rows.groupBy("destino_iata", "airline_name").agg(_avg_delay())


@_visual
def p1_v7_dia_semana(t: Tables) -> DataFrame:
    """Flights and mean delay per weekday."""
    daily = t["fct_vuelos"].groupBy("fecha").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("retraso_salida_min").alias("minutos"),
        F.count("retraso_salida_min").alias("con_dato"),
    )
    days = t["dim_fecha"].select("fecha", "dia_semana_num", "nombre_dia")
    return (
        daily.join(days, "fecha")
        .groupBy("dia_semana_num", "nombre_dia")
        .agg(
            F.sum("n").alias("vuelos"), round_n(ratio(F.sum("minutos"), F.sum("con_dato")), 6).alias("retraso")
        )
    )


@_visual
def p1_v8_evolucion(t: Tables) -> DataFrame:
    """Flights per calendar date; NULL on dates without flights."""
    daily = t["fct_vuelos"].groupBy("fecha").agg(F.count(F.lit(1)).alias("vuelos"))
    return drill_across(t["dim_fecha"].select("fecha", "fecha_display"), "fecha", daily)


@_visual
def p1_v9_control(t: Tables, sigmas: float = 2.0) -> DataFrame:
    """Daily mean delay with control limits over the days."""
    daily = t["fct_vuelos"].groupBy("fecha").agg(_avg_delay())
    return _dated(t, control_limits(daily, "avg_ret", sigmas))


@_visual
def p1_v10_cancelaciones(t: Tables) -> DataFrame:
    """Cancelled flights per ISO week and month of the calendar; NULL where there are none."""
    daily = t["fct_vuelos"].groupBy("fecha").agg(measure("total_cancelados").alias("n"))
    weeks = t["dim_fecha"].select("fecha", "semana_anio", "mes")
    return (
        drill_across(weeks, "fecha", daily)
        .groupBy("semana_anio", "mes")
        .agg(F.nullif(F.sum("n"), F.lit(0)).alias("cancelados"))
    )


@_visual
def p1_v11_semaforo(t: Tables) -> DataFrame:
    """On-time, late and cancelled percent per airline, each counted on its own."""
    return _punctuality(t).select(
        "airline_name",
        _percent("a_tiempo", "n").alias("pct_t"),
        _percent("tarde", "n").alias("pct_r"),
        _percent("cancelados", "n").alias("pct_c"),
    )


# --- page 2: weather --------------------------------------------------------------------


def _daily_climate(t: Tables, **columns: str) -> DataFrame:
    """Mean over the cities of a date, one output column per keyword."""
    return t["fct_clima_diario"].groupBy("fecha").agg(
        *[round_n(F.avg(source), 6).alias(name) for name, source in columns.items()]
    )


def _daily_delay(t: Tables) -> DataFrame:
    return t["fct_vuelos"].groupBy("fecha").agg(_avg_delay("retraso"), F.count(F.lit(1)).alias("vuelos"))


@_visual
def p2_v1_temperatura(t: Tables) -> DataFrame:
    """Temperature, delay and flights of the dates that have both readings."""
    both = drill_across(_daily_climate(t, temp="avg_temp_c"), "fecha", _daily_delay(t))
    dates = t["dim_fecha"].select("fecha")
    return drill_across(dates, "fecha", both).where(F.col("temp").isNotNull() & F.col("retraso").isNotNull())


@_visual
def p2_v2_humedad(t: Tables) -> DataFrame:
    """Humidity and delay of the dates with a humidity reading."""
    both = drill_across(_daily_climate(t, humedad="avg_humidity"), "fecha", _daily_delay(t).drop("vuelos"))
    return _dated(t, both.where(F.col("humedad").isNotNull()))


@_visual
def p2_v3_ciudades(t: Tables, n: int = 10) -> DataFrame:
    """Warmest cities; those without a reading come last."""
    cities = t["fct_clima_diario"].groupBy("ciudad").agg(round_n(measure("avg_temperatura"), 6).alias("temp_avg"))
    return top_with_ties(cities, "temp_avg", n, keep_null=True)


@_visual
def p2_v4_adversas(t: Tables) -> DataFrame:
    """Percent of flights with and without adverse weather."""
    row = t["fct_vuelos"].agg(
        measure("vuelos_afectados_clima").alias("con"), count_where(~F.col("condiciones_adversas")).alias("sin")
    )
    total = F.col("con") + F.col("sin")
    return rows_of(
        row,
        [
            {"orden": F.lit(1), "grupo": F.lit("Con adversas"), "pct": _percent("con", total)},
            {"orden": F.lit(2), "grupo": F.lit("Sin adversas"), "pct": _percent("sin", total)},
        ],
    )


def _by_condition(t: Tables) -> DataFrame:
    return t["fct_vuelos"].groupBy("condicion_clima").agg(_avg_delay(), F.count(F.lit(1)).alias("vuelos"))


@_visual
def p2_v5_condicion(t: Tables, n: int = 8) -> DataFrame:
    """Mean delay per weather condition; conditions without a known delay are left out."""
    return top_with_ties(t["fct_vuelos"].groupBy("condicion_clima").agg(_avg_delay()), "avg_ret", n)


@_visual
def p2_v6_aerolinea_condicion(t: Tables) -> DataFrame:
    """Mean delay per airline and condition."""
    pairs = t["fct_vuelos"].groupBy("airline_name", "condicion_clima").agg(_avg_delay())
    return pairs.where(F.col("avg_ret").isNotNull())


@_visual
def p2_v7_mezcla(t: Tables) -> DataFrame:
    """Climate rows per date and condition."""
    mix = t["fct_clima_diario"].groupBy("fecha", "condicion_predominante").agg(F.count(F.lit(1)).alias("cnt"))
    return _dated(t, mix)


@_visual
def p2_v8_alertas(t: Tables, n: int = 15) -> DataFrame:
    """Adverse days of the airport's city and its late share as origin, most alerts first."""
    airports = t["dim_aeropuerto"].groupBy("airport_iata", "ciudad").agg(
        F.sum("pct_retraso_como_origen").alias("suma"), F.count("pct_retraso_como_origen").alias("num")
    )
    alerts = evaluate(t["fct_clima_diario"], ["dias_con_clima_adverso"], by=["ciudad"])
    joined = left_attach(airports, alerts, "ciudad").groupBy("airport_iata").agg(
        F.sum("dias_con_clima_adverso").alias("dias_adv"),
        round_n(ratio(F.sum("suma"), F.sum("num")), 6).alias("pct_ret"),
    )
    return top_with_ties(joined.where(F.col("dias_adv") > 0), "dias_adv", n)


@_visual
def p2_v9_variabilidad(t: Tables, n: int = 8) -> DataFrame:
    """Population standard deviation of the daily temperature per city."""
    cities = t["fct_clima_diario"].groupBy("ciudad").agg(round_n(F.stddev_pop("avg_temp_c"), 6).alias("std_temp"))
    return top_with_ties(cities, "std_temp", n)


@_visual
def p2_v10_distribucion(t: Tables, n: int = 8) -> DataFrame:
    """Mean delay and flights per weather condition."""
    return top_with_ties(_by_condition(t), "avg_ret", n)


@_visual
def p2_v11_correlacion(t: Tables) -> DataFrame:
    """Correlation of delay and weather over the dates that have both."""
    climate = _daily_climate(
        t, temp="avg_temp_c", humedad="avg_humidity", nubosidad="avg_cloud", viento="avg_wind_kph",
        lluvia="avg_chance_of_rain",
    )
    days = drill_across(climate, "fecha", _daily_delay(t)).where(F.col("retraso").isNotNull())
    return correlation_pairs(days, CORRELATED)


# --- page 3: incidents ------------------------------------------------------------------


@_visual
def p3_v1_cierre(t: Tables) -> DataFrame:
    """Closed and open percent against the target."""
    row = evaluate(t["fct_incidentes"], ["pct_resolucion"])
    return row.select(
        round_n(F.col("pct_resolucion") * 100, 6).alias("pct_cerrado"),
        round_n((1 - F.col("pct_resolucion")) * 100, 6).alias("pct_abierto"),
        F.lit(CLOSURE_TARGET).alias("meta"),
    )


@_visual
def p3_v2_motivos(t: Tables, n: int = 10) -> DataFrame:
    """Incidents per reason and their share of all incidents."""
    groups = t["fct_incidentes"].groupBy("motivo").agg(F.count(F.lit(1)).alias("total"))
    share = _percent(F.col("total"), sum_of_groups(groups, "total"))
    return top_with_ties(groups, "total", n).withColumn("pct", share)


@_visual
def p3_v3_agentes(t: Tables, n: int = 10) -> DataFrame:
    """Agents with the most incidents."""
    return top_with_ties(t["fct_incidentes"].groupBy("agente_id").agg(F.count(F.lit(1)).alias("casos")), "casos", n)


def _closed_and_open(t: Tables) -> DataFrame:
    return t["fct_incidentes"].groupBy("fecha").agg(
        measure("casos_cerrados").alias("cerrados"), measure("casos_abiertos").alias("abiertos")
    )


@_visual
def p3_v4_linea(t: Tables, n: int = 100) -> DataFrame:
    """Closed and open incidents on the first ``n`` dates of the calendar; NULL without incidents."""
    # dates are unique, so there are no ties to keep
    axis = t["dim_fecha"].select("fecha", "fecha_display").orderBy("fecha").limit(n)
    return drill_across(axis, "fecha", _closed_and_open(t))


@_visual
def p3_v4_acumulada(t: Tables) -> DataFrame:
    """Running totals of closed and open incidents over the dates that have any."""
    return _dated(t, running_total(_closed_and_open(t), "fecha", ["cerrados", "abiertos"]))


@_visual
def p3_v5_minutos(t: Tables, n: int = 8) -> DataFrame:
    """Delay minutes per reason."""
    groups = t["fct_incidentes"].groupBy("motivo").agg(F.sum("minutos_retraso_asociado").alias("min_ret"))
    return top_with_ties(groups, "min_ret", n)


@_visual
def p3_v6_reclamos(t: Tables) -> DataFrame:
    """Late flights and incidents of the dates that have incidents."""
    claims = t["fct_incidentes"].groupBy("fecha").agg(F.count(F.lit(1)).alias("reclamos"))
    late = t["fct_vuelos"].groupBy("fecha").agg(count_where(F.col("tiene_retraso")).alias("vuelos_dem"))
    return _dated(t, drill_across(claims, "fecha", late))


@_visual
def p3_v7_tendencia(t: Tables) -> DataFrame:
    """Open and closed incidents of the dates that have open ones."""
    return _dated(t, _closed_and_open(t).where(F.col("abiertos") > 0).select("fecha", "abiertos", "cerrados"))


@_visual
def p3_v8_efectividad(t: Tables) -> DataFrame:
    """Closure percent and mean satisfaction per airline."""
    return t["fct_incidentes"].groupBy("airline_name").agg(
        round_n(measure("pct_resolucion") * 100, 6).alias("pct_res"),
        round_n(measure("avg_satisfaccion"), 6).alias("avg_sat"),
    )


@_visual
def p3_v9_quejas(t: Tables, n: int = 8) -> DataFrame:
    """Incidents per reason, the most frequent."""
    return top_with_ties(t["fct_incidentes"].groupBy("motivo").agg(F.count(F.lit(1)).alias("total")), "total", n)


@_visual
def p3_v10_detalle(t: Tables, n: int = 10) -> DataFrame:
    """The latest incidents; all incidents of the last date that makes the cut."""
    return latest_with_ties(t["fct_incidentes"], "fecha", n).select(
        "incidente_id", "fecha", "airline_name", "motivo", "estado", "minutos_retraso_asociado",
        "satisfaccion_cliente", "tiempo_resolucion_horas",
    )


@_visual
def p3_v11_kpi(t: Tables) -> DataFrame:
    """Five KPIs beside their targets."""
    row = t["fct_incidentes"].agg(
        (measure("pct_resolucion") * 100).alias("TasaCierre"),
        measure("avg_tiempo_resolucion").alias("TiempoRes"),
        measure("avg_satisfaccion").alias("Satisfaccion"),
        measure("casos_cerrados").alias("CasosCerrados"),
        F.sum(F.when(F.col("is_resolved"), F.col("minutos_retraso_asociado"))).alias("MinEvitados"),
    )
    return rows_of(
        row,
        [
            {
                "orden": F.lit(i),
                "kpi": F.lit(kpi),
                "valor": round_n(F.col(kpi).cast("double"), 6),
                "meta": F.lit(target),
            }
            for i, (kpi, target) in enumerate(KPI_TARGETS.items(), 1)
        ],
    )
