"""Expression operators: each label or class with its number of rows in the bound tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar, rules, text
from ..functions.numeric import coalesce0, pct, round_n
from ..operators.shape import select_as
from ..plans import marts
from ..plans.measures import evaluate, measure
from .registry import register


def tally(df: DataFrame, label: Column, name: str) -> DataFrame:
    return df.groupBy(label.alias(name)).agg(F.count(F.lit(1)).alias("n"))


register(
    "b4_select_as",
    lambda t: select_as(t.delays, {"agente": "user_id", "incidente": "incident_id", "cerrado": "is_resolved"}),
    "select user_id as agente, incident_id as incidente, is_resolved as cerrado from delays",
)
register(
    "b5_coalesce0",
    lambda t: t.flights.groupBy("flight_status").agg(
        F.sum(coalesce0("departure_delay_min")).alias("salida"),
        F.sum(coalesce0("arrival_delay_min")).alias("llegada"),
        F.count_if(coalesce0("departure_delay_min") == 0).alias("ceros"),
    ),
    """select flight_status, sum(ifnull(departure_delay_min, 0))::bigint as salida,
         sum(ifnull(arrival_delay_min, 0))::bigint as llegada,
         count(*) filter (departure_delay_min is null or departure_delay_min = 0) as ceros
       from flights group by flight_status""",
)


def _key_filter(t):
    kept = {
        "flights": t.stg_flights.where(F.col("airline_iata").isNotNull()),
        "weather": t.stg_weather,
        "condition": t.stg_weather.where(F.col("condition").isNotNull()),
        "delays": t.stg_delays,
    }
    counts = [df.agg(F.lit(name).alias("clave"), F.count(F.lit(1)).alias("n")) for name, df in kept.items()]
    return reduce(DataFrame.unionAll, counts)


register(
    "b6_key_filter",
    _key_filter,
    """select 'flights' as clave, count(airline_iata) as n from stg_flights
       union all select 'weather', count(*) from stg_weather
       union all select 'condition', count(condition) from stg_weather
       union all select 'delays', count(*) from stg_delays""",
)
register(
    "b7_status",
    lambda t: tally(t.flights, rules.decode_status("flight_status"), "estado"),
    """select case lower(flight_status) when 'landed' then 'completado' when 'scheduled' then 'programado'
         when 'active' then 'en_vuelo' when 'cancelled' then 'cancelado' else 'desconocido' end as estado, count(*) as n
       from flights group by 1""",
)
register(
    "b8_late",
    lambda t: tally(t.flights, rules.is_late("departure_delay_min"), "tarde"),
    "select ifnull(departure_delay_min, 0) > 15 as tarde, count(*) as n from flights group by 1",
)
register(
    "b9_severity",
    lambda t: tally(t.flights, rules.delay_severity("departure_delay_min"), "severidad"),
    "select severidad_retraso as severidad, count(*) as n from stg_flights group by 1",
)
register(
    "b10_visibility",
    lambda t: tally(t.weather, rules.visibility_class("visibility_km"), "clase"),
    "select visibilidad_categoria as clase, count(*) as n from stg_weather group by 1",
)
register(
    "b11_wind",
    lambda t: tally(t.weather, rules.wind_class("wind_kph"), "clase"),
    "select viento_categoria as clase, count(*) as n from stg_weather group by 1",
)
register(
    "b12_temperature",
    lambda t: tally(t.weather, rules.temperature_class("temp_c"), "clase"),
    "select temperatura_categoria as clase, count(*) as n from stg_weather group by 1",
)
register(
    "b13_adverse",
    lambda t: tally(t.weather, rules.is_adverse(), "adversa"),
    "select condiciones_adversas as adversa, count(*) as n from stg_weather group by 1",
)
register(
    "b14_priority",
    lambda t: tally(
        t.delays, text.classify_text("incident_title", text.PRIORITY_KEYWORDS, text.PRIORITY_DEFAULT), "prioridad"
    ),
    "select prioridad, count(*) as n from stg_delays group by 1",
)
register(
    "b15_state",
    lambda t: tally(t.delays, rules.incident_state("is_resolved"), "estado"),
    "select estado_incidente as estado, count(*) as n from stg_delays group by 1",
)
register(
    "b16_condition_group",
    lambda t: tally(
        t.stg_weather.where(F.col("condition").isNotNull()),
        text.classify_text("condition", text.CONDITION_KEYWORDS, text.CONDITION_DEFAULT),
        "grupo",
    ),
    """select grupo_condicion as grupo, sum(frecuencia)::bigint as n from dim_condicion_clima group by 1""",
)
register(
    "b17_impact",
    lambda t: tally(t.dim_condicion_clima, F.col("impacto_operativo"), "impacto"),
    "select impacto_operativo as impacto, count(*) as n from dim_condicion_clima group by 1",
)
register(
    "b18_reliability",
    lambda t: tally(t.dim_aerolinea, F.col("confiabilidad"), "confiabilidad"),
    "select confiabilidad, count(*) as n from dim_aerolinea group by 1",
)
register(
    "b19_critical_lean",
    lambda t: tally(
        marts.join_daily(t.int_flights_daily, t.int_weather_daily, t.incidents_per_day),
        rules.critical_day(form="lean"),
        "dia_critico",
    ),
    "select dia_critico, count(*) as n from fct_lean group by 1",
)
register(
    "b20_critical_full",
    lambda t: tally(
        marts.join_daily(t.int_flights_daily, t.int_weather_daily, t.int_delays_daily),
        rules.critical_day(form="full"),
        "dia_critico",
    ),
    "select dia_critico, count(*) as n from fct_full group by 1",
)
register(
    "b21_score",
    lambda t: tally(
        marts.join_daily(t.int_flights_daily, t.int_weather_daily, t.int_delays_daily),
        rules.performance_score("pct_vuelos_completados", "pct_vuelos_con_retraso", "pct_resolucion"),
        "score",
    ),
    "select score_rendimiento as score, count(*) as n from fct_full group by 1",
)
register(
    "b22_weather_impact",
    lambda t: tally(
        marts.join_daily(t.int_flights_daily, t.int_weather_daily, t.int_delays_daily),
        rules.weather_impact("hubo_condiciones_adversas", "pct_vuelos_con_retraso"),
        "impacto",
    ),
    "select clima_impacto_operaciones as impacto, count(*) as n from fct_full group by 1",
)


def _tagged(t):
    def tag(column, kind):
        return t.stg_flights.select(F.col(column).alias("airport_iata"), F.lit(kind).alias("tipo")).distinct()

    both = tag("departure_iata", "origen").unionAll(tag("arrival_iata", "destino"))
    return tally(both, F.col("tipo"), "tipo")


register(
    "b23_tag",
    _tagged,
    """select 'origen' as tipo, count(distinct departure_iata) as n from stg_flights
       union all select 'destino', count(distinct arrival_iata) from stg_flights""",
)
register(
    "b24_in_list",
    lambda t: t.stg_flights.where(F.month("flight_date").isin(1, 2, 3))
    .groupBy(calendar.is_weekend("flight_date").alias("fin_de_semana"))
    .agg(F.count(F.lit(1)).alias("n")),
    """select strftime(flight_date, '%w') in ('0', '6') as fin_de_semana, count(*) as n from stg_flights
       where month(flight_date) in (1, 2, 3) group by 1""",
)
register(
    "b25_not_blank",
    lambda t: tally(
        t.fct_vuelos.where(F.col("retraso_salida_min").isNotNull() & F.col("condicion_clima").isNotNull()),
        F.col("condicion_clima"),
        "condicion",
    ),
    """select condicion_clima as condicion, count(*) as n from fct_vuelos
       where retraso_salida_min is not null and condicion_clima is not null group by 1""",
)
register(
    "b26_filter_context",
    lambda t: evaluate(
        t.fct_vuelos,
        [
            measure("total_vuelos"),
            measure("total_vuelos", where=F.col("condiciones_adversas")).alias("con_adversas"),
            measure("total_min_retraso", where=F.col("tiene_retraso")).alias("minutos_tarde"),
            measure("pct_a_tiempo", where=F.col("condiciones_adversas")).alias("pct_a_tiempo_adversas"),
        ],
        by=["airline_name"],
    ),
    """select airline_name, count(*) as total_vuelos, count(*) filter (condiciones_adversas) as con_adversas,
         sum(retraso_salida_min) filter (tiene_retraso)::bigint as minutos_tarde,
         (count(*) filter (condiciones_adversas and not tiene_retraso))::double
           / nullif(count(*) filter (condiciones_adversas), 0) as pct_a_tiempo_adversas
       from fct_vuelos group by 1""",
)

# scalar functions

register(
    "g_text",
    lambda t: t.fct_incidentes.groupBy("motivo", "fecha")
    .agg(F.count(F.lit(1)).alias("n"), F.sum("minutos_retraso_asociado").alias("minutos"),
         F.avg("minutos_retraso_asociado").alias("media"))
    .select(
        text.join_text(F.lower("motivo"), F.lit("~"), "n").alias("clave"),
        F.lower("motivo").contains("err").alias("es_error"),
        text.fmt_decimals("media", 1).alias("media_1"),
        text.fmt_decimals("media", 2).alias("media_2"),
        text.fmt_decimals("n", 0).alias("n_0"),
        text.fmt_thousands("minutos").alias("miles"),
        text.fmt_date("fecha", "dd/MM/yy").alias("dia_corto"),
        text.fmt_date("fecha").alias("dia"),
    ),
    """select lower(motivo) || '~' || count(*) as clave, contains(lower(motivo), 'err') as es_error,
         round(avg(minutos_retraso_asociado)::decimal(18,6), 1)::decimal(18,1)::varchar as media_1,
         round(avg(minutos_retraso_asociado)::decimal(18,6), 2)::decimal(18,2)::varchar as media_2,
         count(*)::varchar as n_0, format('{:,}', sum(minutos_retraso_asociado)::bigint) as miles,
         strftime(fecha, '%d/%m/%y') as dia_corto, strftime(fecha, '%d/%m/%Y') as dia
       from fct_incidentes group by motivo, fecha""",
)
register(
    "g_calendar",
    lambda t: t.stg_flights.groupBy("flight_date").agg(F.count(F.lit(1)).alias("n")).select(
        "flight_date", "n", *calendar.calendar_columns("flight_date")
    ),
    """select flight_date, n, d.* exclude (fecha)
       from (select flight_date, count(*) as n from stg_flights group by 1) join dim_fecha d on d.fecha = flight_date""",
)
register(
    "g_numeric",
    lambda t: t.stg_flights.groupBy("airline_iata")
    .agg(
        F.avg("departure_delay_min").alias("media"),
        F.count_if(F.col("flight_status") == "cancelado").alias("k"),
        F.count(F.lit(1)).alias("n"),
        F.max(F.col("tiene_retraso").cast("int")).alias("alguno"),
        F.sum(F.pow(F.col("departure_delay_min").cast("double"), F.lit(2.0))).alias("s2"),
    )
    .select(
        "airline_iata",
        "alguno",
        round_n("media", 2).alias("media"),
        F.nullif("k", F.lit(0)).alias("k_o_nulo"),
        pct("k", "n").alias("pct"),
        pct("n", "k").alias("inverso"),
        F.coalesce(F.nullif("k", F.lit(0)), F.lit(-1)).alias("k_o_menos_uno"),
        round_n(F.sqrt(F.col("s2") / F.col("n")), 4).alias("rms"),
        F.greatest(F.lit(0.0), round_n("media", 2)).alias("no_negativo"),
        F.when(F.col("k") >= 3, "muchos").otherwise("pocos").alias("grupo"),
    ),
    """select airline_iata, max(tiene_retraso::int) as alguno,
         round(avg(departure_delay_min)::decimal(18,6), 2)::double as media, nullif(k, 0) as k_o_nulo,
         round((100.0 * k / count(*))::decimal(18,6), 2)::double as pct,
         round((100.0 * count(*) / nullif(k, 0))::decimal(18,6), 2)::double as inverso,
         if(k = 0, -1, k) as k_o_menos_uno,
         round(sqrt(sum(departure_delay_min::double ** 2) / count(*))::decimal(18,6), 4)::double as rms,
         greatest(0.0::double, round(avg(departure_delay_min)::decimal(18,6), 2)::double) as no_negativo,
         if(k >= 3, 'muchos', 'pocos') as grupo
       from (select *, count(*) filter (flight_status = 'cancelado') over (partition by airline_iata) as k from stg_flights)
       group by airline_iata, k""",
)
