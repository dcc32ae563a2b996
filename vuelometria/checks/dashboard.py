"""Base measures and dashboard visuals."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from ..functions.numeric import round_n
from ..plans.measures import evaluate, measure, measure_names
from ..plans.payloads import visual_payload
from ..plans.visuals import visual
from .registry import register

# --- measures ---------------------------------------------------------------------------

_VUELOS_SQL = """count(*) as total_vuelos, count(*) filter (not tiene_retraso) as vuelos_a_tiempo,
  (count(*) filter (not tiene_retraso))::double / count(*) as pct_a_tiempo,
  count(*) filter (flight_status = 'cancelled') as total_cancelados,
  (count(*) filter (flight_status = 'cancelled'))::double / count(*) as pct_cancelados,
  avg(retraso_salida_min) as avg_retraso_min, sum(retraso_salida_min)::bigint as total_min_retraso,
  (count(*) filter (not tiene_retraso))::double / nullif(count(*) filter (flight_status <> 'cancelled'), 0)
    as indice_eficiencia,
  count(*) filter (condiciones_adversas) as vuelos_afectados_clima
from fct_vuelos"""
_INCIDENTES_SQL = """count(*) as total_incidentes, count(*) filter (is_resolved) as casos_cerrados,
  count(*) filter (is_resolved is null or not is_resolved) as casos_abiertos,
  (count(*) filter (is_resolved))::double / count(*) as pct_resolucion,
  avg(satisfaccion_cliente) as avg_satisfaccion, avg(tiempo_resolucion_horas) as avg_tiempo_resolucion
from fct_incidentes"""
_CLIMA_SQL = """round(avg(avg_temp_c)::decimal(18,6), 6)::double as avg_temperatura,
  count(*) filter (hubo_condiciones_adversas) as dias_con_clima_adverso
from fct_clima_diario"""


def _all_measures(t, table, by=()):
    # the climate means are sums of decimal fractions: compare them without the last bits
    columns = [
        round_n(measure(n), 6).alias(n) if n == "avg_temperatura" else measure(n) for n in measure_names(table)
    ]
    return evaluate(t.facts[table], columns, by)


for _key, _table, _sql, _by in (
    ("i_vuelos", "fct_vuelos", _VUELOS_SQL, ("airline_name", "flight_status")),
    ("i_incidentes", "fct_incidentes", _INCIDENTES_SQL, ("motivo", "airline_name")),
    ("i_clima", "fct_clima_diario", _CLIMA_SQL, ("ciudad",)),
):
    register(_key, partial(_all_measures, table=_table), f"select {_sql}")
    register(f"{_key}_by", partial(_all_measures, table=_table, by=_by), f"select {', '.join(_by)}, {_sql} group by all")

# --- visuals ----------------------------------------------------------------------------


def _r6(expr: str) -> str:
    return f"round(({expr})::decimal(18,6), 6)::double"


_ROWS: dict[str, str] = {}


def _visual(key: str, name: str, sql: str, **options) -> None:
    _ROWS[name] = sql
    register(key, lambda t: visual(name)(t.facts, t.dims, **options), sql)


_DELAY = _r6("avg(retraso_salida_min)") + " as avg_ret"
_SHARES = """airline_name, count(*) as n, (count(*) filter (not tiene_retraso))::double / count(*) as t,
  (count(*) filter (tiene_retraso))::double / count(*) as r,
  (count(*) filter (flight_status = 'cancelled'))::double / count(*) as c"""

_visual(
    "j1_rutas", "p1_v1_rutas",
    """select * from (select origen_iata, destino_iata, count(*) as vuelos from fct_vuelos group by 1, 2)
       qualify rank() over (order by vuelos desc) <= 30""",
)
_visual(
    "j2_aerolineas_retraso", "p1_v2_aerolineas_retraso",
    f"""select * from (select airline_name, {_DELAY} from fct_vuelos group by 1)
        qualify rank() over (order by avg_ret desc nulls last) <= 10""",
)
_visual(
    "j3_barra_apilada", "p1_v3_barra_apilada",
    f"""select airline_name, {_r6('t * 100')} as pct_t, {_r6('greatest(0, 1 - t - c) * 100')} as pct_r,
          {_r6('c * 100')} as pct_c from (select {_SHARES} from fct_vuelos group by 1)""",
)
_visual(
    "j4_embudo", "p1_v4_embudo",
    f"""select unnest([1, 2, 3, 4]) as orden, unnest(['Planificados', 'Ejecutados', 'Completados', 'Cancelados']) as etapa,
          unnest([{_r6('n / (1 - if(c >= n, 0.999, c / n))')}, n::double, t::double, c::double]) as valor
        from (select count(*)::double as n, count(*) filter (not tiene_retraso) as t,
                count(*) filter (flight_status = 'cancelled') as c from fct_vuelos)""",
)
_visual(
    "j5_destinos", "p1_v5_destinos",
    f"""select destino_iata, vuelos, {_r6('vuelos::double / total * 100')} as pct
        from (select *, sum(vuelos) over () as total, rank() over (order by vuelos desc) as pos
              from (select destino_iata, count(*) as vuelos from fct_vuelos group by 1)) where pos <= 15""",
)
_KEY_NATIONS = ("NATION_1", "NATION_7", "NATION_12", "NATION_18", "NATION_24")
_visual(
    "j6_destino_aerolinea", "p1_v6_destino_aerolinea",
    f"select destino_iata, airline_name, {_DELAY} from fct_vuelos where destino_iata in {_KEY_NATIONS} group by 1, 2",
    destinations=_KEY_NATIONS,
)
_visual(
    "j7_dia_semana", "p1_v7_dia_semana",
    f"""select dia_semana_num, nombre_dia, count(*) as vuelos, {_r6('avg(retraso_salida_min)')} as retraso
        from fct_vuelos join dim_fecha using (fecha) group by 1, 2""",
)
_visual(
    "j8_evolucion", "p1_v8_evolucion",
    """select fecha, fecha_display, vuelos
       from dim_fecha left join (select fecha, count(*) as vuelos from fct_vuelos group by 1) using (fecha)""",
)
_visual(
    "j9_control", "p1_v9_control",
    f"""select fecha, strftime(fecha, '%d/%m/%Y') as fecha_display, avg_ret, {_r6('m')} as media,
          {_r6('m + 2 * s')} as lsc, {_r6('greatest(0, m - 2 * s)')} as lic
        from (select *, avg(avg_ret) over () as m, stddev_pop(avg_ret) over () as s
              from (select fecha, {_DELAY} from fct_vuelos group by 1))""",
)
_visual(
    "j10_cancelaciones", "p1_v10_cancelaciones",
    """select semana_anio, mes, nullif(count(*) filter (flight_status = 'cancelled'), 0) as cancelados
       from dim_fecha left join fct_vuelos using (fecha) group by 1, 2""",
)
_visual(
    "j11_semaforo", "p1_v11_semaforo",
    f"""select airline_name, {_r6('t * 100')} as pct_t, {_r6('r * 100')} as pct_r, {_r6('c * 100')} as pct_c
        from (select {_SHARES} from fct_vuelos group by 1)""",
)
_DAY_DELAY = f"(select fecha, {_r6('avg(retraso_salida_min)')} as retraso, count(*) as vuelos from fct_vuelos group by 1)"
_DAY_CLIMATE = f"""(select fecha, {_r6('avg(avg_temp_c)')} as temp, {_r6('avg(avg_humidity)')} as humedad,
  {_r6('avg(avg_cloud)')} as nubosidad, {_r6('avg(avg_wind_kph)')} as viento, {_r6('avg(avg_chance_of_rain)')} as lluvia
  from fct_clima_diario group by 1)"""
_visual(
    "j12_temperatura", "p2_v1_temperatura",
    f"select fecha, temp, retraso, vuelos from {_DAY_CLIMATE} join {_DAY_DELAY} using (fecha) where retraso is not null",
)
_visual(
    "j13_humedad", "p2_v2_humedad",
    f"""select fecha, strftime(fecha, '%d/%m/%Y') as fecha_display, humedad, retraso
        from {_DAY_CLIMATE} left join {_DAY_DELAY} using (fecha) where humedad is not null""",
)
_visual(
    "j14_ciudades", "p2_v3_ciudades",
    f"""select * from (select ciudad, {_r6('avg(avg_temp_c)')} as temp_avg from fct_clima_diario group by 1)
        qualify rank() over (order by temp_avg desc nulls last) <= 10""",
)
_visual(
    "j15_adversas", "p2_v4_adversas",
    f"""select unnest([1, 2]) as orden, unnest(['Con adversas', 'Sin adversas']) as grupo,
          unnest([{_r6('a::double / n * 100')}, {_r6('(n - a)::double / n * 100')}]) as pct
        from (select count(*) as n, count(*) filter (condiciones_adversas) as a from fct_vuelos)""",
)
_visual(
    "j16_condicion", "p2_v5_condicion",
    f"""select * from (select condicion_clima, {_DELAY} from fct_vuelos group by 1) where avg_ret is not null
        qualify rank() over (order by avg_ret desc) <= 8""",
)
_visual(
    "j17_aerolinea_condicion", "p2_v6_aerolinea_condicion",
    f"select airline_name, condicion_clima, {_DELAY} from fct_vuelos group by 1, 2 having count(retraso_salida_min) > 0",
)
_visual(
    "j18_mezcla", "p2_v7_mezcla",
    """select fecha, strftime(fecha, '%d/%m/%Y') as fecha_display, condicion_predominante, count(*) as cnt
       from fct_clima_diario group by 1, 3""",
)
_visual(
    "j19_alertas", "p2_v8_alertas",
    f"""select * from (
          select airport_iata, count(*) as dias_adv, {_r6('avg(pct_retraso_como_origen)')} as pct_ret
          from dim_aeropuerto join airport_cities using (airport_iata) join fct_clima_diario using (ciudad)
          where hubo_condiciones_adversas group by 1)
        qualify rank() over (order by dias_adv desc) <= 15""",
)
_visual(
    "j20_variabilidad", "p2_v9_variabilidad",
    f"""select * from (select ciudad, {_r6('stddev_pop(avg_temp_c)')} as std_temp from fct_clima_diario group by 1)
        qualify rank() over (order by std_temp desc) <= 8""",
)
_visual(
    "j21_distribucion", "p2_v10_distribucion",
    f"""select * from (select condicion_clima, {_DELAY}, count(*) as vuelos from fct_vuelos group by 1)
        where avg_ret is not null qualify rank() over (order by avg_ret desc) <= 8""",
)
_CORR = {"Retraso": "retraso", "Temp": "temp", "Humedad": "humedad", "Nubosidad": "nubosidad", "Viento": "viento",
         "Lluvia": "lluvia"}
_names = list(_CORR)
_pairs = [(x, y) for i, x in enumerate(_names) for y in _names[i + 1 :]]
_visual(
    "j22_correlacion", "p2_v11_correlacion",
    "select " + f"unnest(range(1, {len(_pairs) + 1}))::int as orden, "
    + f"unnest({[x for x, _ in _pairs]}) as var_x, unnest({[y for _, y in _pairs]}) as var_y, "
    + "unnest([" + ", ".join(_r6(f"corr({_CORR[x]}, {_CORR[y]})") for x, y in _pairs) + "]) as r "
    + f"from {_DAY_CLIMATE} join {_DAY_DELAY} using (fecha) where retraso is not null",
)
_visual(
    "j23_cierre", "p3_v1_cierre",
    f"""select {_r6('p * 100')} as pct_cerrado, {_r6('(1 - p) * 100')} as pct_abierto, 80 as meta
        from (select (count(*) filter (is_resolved))::double / count(*) as p from fct_incidentes)""",
)
_visual(
    "j24_motivos", "p3_v2_motivos",
    f"""select motivo, total, {_r6('total::double / todos * 100')} as pct
        from (select *, sum(total) over () as todos, rank() over (order by total desc) as pos
              from (select motivo, count(*) as total from fct_incidentes group by 1)) where pos <= 10""",
)
_visual(
    "j25_agentes", "p3_v3_agentes",
    """select * from (select agente_id, count(*) as casos from fct_incidentes group by 1)
       qualify rank() over (order by casos desc) <= 10""",
)
_DAY_CASES = """(select fecha, count(*) filter (is_resolved) as cerrados,
  count(*) filter (is_resolved is not true) as abiertos from fct_incidentes group by 1)"""
_visual(
    "j26_linea", "p3_v4_linea",
    f"""select fecha, fecha_display, cerrados, abiertos
        from (select * from dim_fecha qualify rank() over (order by fecha) <= 100) left join {_DAY_CASES} using (fecha)""",
)
_visual(
    "j26_acumulada", "p3_v4_acumulada",
    f"""select fecha, strftime(fecha, '%d/%m/%Y') as fecha_display, cerrados, abiertos,
          sum(cerrados) over (order by fecha)::bigint as cerrados_acum,
          sum(abiertos) over (order by fecha)::bigint as abiertos_acum from {_DAY_CASES}""",
)
_visual(
    "j27_minutos", "p3_v5_minutos",
    """select * from (select motivo, sum(minutos_retraso_asociado)::bigint as min_ret from fct_incidentes group by 1)
       qualify rank() over (order by min_ret desc) <= 8""",
)
_visual(
    "j28_reclamos", "p3_v6_reclamos",
    """select fecha, strftime(fecha, '%d/%m/%Y') as fecha_display, reclamos, vuelos_dem
       from (select fecha, count(*) as reclamos from fct_incidentes group by 1)
       left join (select fecha, count(*) filter (tiene_retraso) as vuelos_dem from fct_vuelos group by 1) using (fecha)""",
)
_visual(
    "j29_tendencia", "p3_v7_tendencia",
    f"""select fecha, strftime(fecha, '%d/%m/%Y') as fecha_display, abiertos, cerrados from {_DAY_CASES}
        where abiertos > 0""",
)
_visual(
    "j30_efectividad", "p3_v8_efectividad",
    f"""select airline_name, {_r6('100 * (count(*) filter (is_resolved))::double / count(*)')} as pct_res,
          {_r6('avg(satisfaccion_cliente)')} as avg_sat from fct_incidentes group by 1""",
)
_visual(
    "j31_quejas", "p3_v9_quejas",
    """select * from (select motivo, count(*) as total from fct_incidentes group by 1)
       qualify rank() over (order by total desc) <= 8""",
)
_visual(
    "j32_detalle", "p3_v10_detalle",
    """select incidente_id, fecha, airline_name, motivo, estado, minutos_retraso_asociado, satisfaccion_cliente,
         tiempo_resolucion_horas from fct_incidentes qualify rank() over (order by fecha desc) <= 10""",
)
_visual(
    "j33_bullet", "p3_v11_kpi",
    f"""select unnest([1, 2, 3, 4, 5]) as orden, 
          unnest(['TasaCierre', 'TiempoRes', 'Satisfaccion', 'CasosCerrados', 'MinEvitados']) as kpi,
          unnest([{_r6('100 * (count(*) filter (is_resolved))::double / count(*)')},
            {_r6('avg(tiempo_resolucion_horas)')}, {_r6('avg(satisfaccion_cliente)')},
            (count(*) filter (is_resolved))::double,
            (sum(minutos_retraso_asociado) filter (is_resolved))::double]) as valor,
          unnest([80, 20, 4, 20000, 40000])::double as meta
        from fct_incidentes""",
)

# --- payload texts ----------------------------------------------------------------------


def _payload(key: str, name: str, sql: str) -> None:
    register(key, lambda t: visual_payload(name)(t.facts, t.dims), sql)


def _f(expr: str, digits: int = 1) -> str:
    return f"ifnull(round(({expr})::decimal(18,6), {digits})::decimal(18,{digits})::varchar, '')"


_payload(
    "j1_payload", "p1_v1_rutas",
    """select 'mapa_rutas' as tipo, origen_iata || '→' || destino_iata || ':' || vuelos as payload,
         vuelos, origen_iata, destino_iata
       from (select * from (select origen_iata, destino_iata, count(*) as vuelos from fct_vuelos group by 1, 2)
             qualify rank() over (order by vuelos desc) <= 30)""",
)
_payload(
    "j9_payload", "p1_v9_control",
    f"""select '{{"tipo":"control_chart","lsc":' || {_f('max(m + 2 * s)')} || ',"lic":' || {_f('max(greatest(0, m - 2 * s))')}
          || ',"media":' || {_f('max(m)')} || ',"data":"'
          || string_agg(strftime(fecha, '%d/%m/%Y') || ':' || {_f('avg_ret')}, '|' order by fecha) || '"}}' as payload
        from (select *, avg(avg_ret) over () as m, stddev_pop(avg_ret) over () as s
              from (select fecha, {_DELAY} from fct_vuelos group by 1))""",
)
_payload(
    "j11_payload", "p1_v11_semaforo",
    f"""select 'semaforo' as tipo, 'aerolinea:pct_tiempo:pct_retraso:pct_cancelado' as cols,
          concat_ws(':', airline_name, {_f('t * 100')}, {_f('r * 100')}, {_f('c * 100')}) as payload,
          {_r6('t * 100')} as pct_t, airline_name
        from (select {_SHARES} from fct_vuelos group by 1)""",
)
_payload(
    "j23_payload", "p3_v1_cierre",
    f"""select '{{"tipo":"donut_kpi","kpi":' || {_f('p * 100')} || ',"label":"Casos Completados","meta":80,"data":"Completados:'
          || {_f('p * 100')} || '|Pendientes:' || {_f('(1 - p) * 100')} || '"}}' as payload
        from (select (count(*) filter (is_resolved))::double / count(*) as p from fct_incidentes)""",
)
_payload(
    "j27_payload", "p3_v5_minutos",
    """select '{"tipo":"barra_h","titulo":"Motivos · Minutos de Retraso Asociado","data":"'
         || string_agg(motivo || ':' || format('{:,}', m), '|' order by m desc, motivo) || '"}' as payload
       from (select * from (select motivo, sum(minutos_retraso_asociado)::bigint as m from fct_incidentes group by 1)
             qualify rank() over (order by m desc) <= 8)""",
)
_payload(
    "j32_payload", "p3_v10_detalle",
    f"""select incidente_id || '~' || strftime(fecha, '%d/%m/%y') || '~' || airline_name || '~' || motivo || '~' || estado
          || '~' || minutos_retraso_asociado || '~' || {_f('satisfaccion_cliente')} || '~' || {_f('tiempo_resolucion_horas')}
          as payload, 'tabla' as tipo, 'id~fecha~aerolinea~motivo~estado~min_ret~satisfaccion~tiempo_res' as cols,
          fecha, incidente_id
        from fct_incidentes qualify rank() over (order by fecha desc) <= 10""",
)
_payload(
    "j33_payload", "p3_v11_kpi",
    f"""select '{{"tipo":"bullet_kpi","data":"TasaCierre:' || {_f('100.0 * count(*) filter (is_resolved) / count(*)')}
          || ':80|TiempoRes:' || {_f('avg(tiempo_resolucion_horas)')} || ':20|Satisfaccion:'
          || {_f('avg(satisfaccion_cliente)', 2)} || ':4.0|CasosCerrados:' || count(*) filter (is_resolved)
          || ':20000|MinEvitados:' || format('{{:,}}', (sum(minutos_retraso_asociado) filter (is_resolved))::bigint)
          || ':40000"}}' as payload from fct_incidentes""",
)

# Written from the dashboard's own texts: visual, header, line and order over the rows of the visual.
for _key, _name, _header, _line, _order in (
    ("j4_payload", "p1_v4_embudo", '"tipo":"funnel"', f"etapa, ':', {_f('valor', 0)}", "orden"),
    ("j5_payload", "p1_v5_destinos", '"tipo":"treemap","cols":"destino:vuelos:pct"',
     f"destino_iata, ':', vuelos, ':', {_f('pct')}", "vuelos desc, destino_iata"),
    ("j7_payload", "p1_v7_dia_semana", '"tipo":"heatmap","cols":"dia:vuelos:retraso"',
     f"nombre_dia, ':', vuelos, ':', {_f('retraso')}", "dia_semana_num"),
    ("j8_payload", "p1_v8_evolucion", '"tipo":"linea"', "fecha_display, ':', vuelos", "fecha"),
    ("j10_payload", "p1_v10_cancelaciones", '"tipo":"waterfall"', "'Sem', semana_anio, ':', cancelados", "semana_anio, mes"),
    ("j12_payload", "p2_v1_temperatura", '"tipo":"scatter","cols":"temp:retraso:vuelos"',
     f"{_f('temp')}, ':', {_f('retraso')}, ':', vuelos", "fecha"),
    ("j13_payload", "p2_v2_humedad", '"tipo":"combo_barra_linea","cols":"fecha:humedad:retraso"',
     f"fecha_display, ':', {_f('humedad')}, ':', {_f('retraso')}", "fecha"),
    ("j14_payload", "p2_v3_ciudades", '"tipo":"barra_h","titulo":"Ranking Termométrico · °C"',
     f"ciudad, ':', {_f('temp_avg')}", "temp_avg desc, ciudad"),
    ("j24_payload", "p3_v2_motivos", '"tipo":"treemap","cols":"motivo:total:pct"',
     f"motivo, ':', total, ':', {_f('pct')}", "total desc, motivo"),
    ("j28_payload", "p3_v6_reclamos", '"tipo":"combo_linea_linea","cols":"fecha:vuelos_demorados:reclamos"',
     "fecha_display, ':', vuelos_dem, ':', reclamos", "fecha"),
    ("j29_payload", "p3_v7_tendencia", '"tipo":"linea_dual","cols":"fecha:abiertos:cerrados"',
     "fecha_display, ':', abiertos, ':', cerrados", "fecha"),
    ("j31_payload", "p3_v9_quejas", '"tipo":"funnel","titulo":"Gravedad Motivos de Queja"',
     "motivo, ':', total", "total desc, motivo"),
):
    _payload(
        _key, _name,
        f"""select '{{{_header},"data":"' || string_agg(concat({_line}), '|' order by {_order}) || '"}}' as payload
            from ({_ROWS[_name]})""",
    )

register(
    "j_slicers",
    lambda t: visual("p1_v1_rutas")(
        t.facts, t.dims, where={"dim_fecha": F.col("trimestre") == "Q1", "fct_vuelos": F.col("flight_status") != "cancelled"}
    ),
    """select * from (select origen_iata, destino_iata, count(*) as vuelos from fct_vuelos join dim_fecha using (fecha)
                      where trimestre = 'Q1' and flight_status <> 'cancelled' group by 1, 2)
       qualify rank() over (order by vuelos desc) <= 30""",
)
