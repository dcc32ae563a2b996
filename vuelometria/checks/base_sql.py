"""DuckDB views of the domain tables and models, as named subqueries.

Written from the definitions of the tables, not from the Spark code: both sides must agree.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}

VIEWS["flights"] = """
select l_shipdate::date as flight_date,
  case when l_discount > 0.095 then 'cancelled' when l_tax > 0.075 then 'diverted'
       when o_orderstatus = 'F' then 'Landed' when o_orderstatus = 'O' then 'scheduled' else 'active' end as flight_status,
  'Airport ' || ns.n_name as departure_airport, ns.n_name as departure_iata,
  l_shipdate::date::varchar as departure_scheduled,
  (case when l_returnflag = 'R' then if(s_suppkey % 4 < 2, floor(l_quantity) - 40, floor(l_quantity) * 5)
        when l_returnflag = 'N' then if(s_suppkey % 4 = 0, floor(l_quantity) - 30, floor(l_quantity) - 10) end)::int
    as departure_delay_min,
  'Airport ' || nc.n_name as arrival_airport, nc.n_name as arrival_iata,
  l_shipdate::date::varchar as arrival_scheduled,
  (case when l_linestatus = 'F' then floor(l_quantity) - 5 end)::int as arrival_delay_min,
  s_name as airline_name, 'S' || s_suppkey as airline_iata,
  l_orderkey || '-' || l_linenumber as flight_number, rs.r_name as origin_city
from lineitem
join orders on l_orderkey = o_orderkey
join supplier on l_suppkey = s_suppkey
join customer on o_custkey = c_custkey
join nation ns on s_nationkey = ns.n_nationkey
join nation nc on c_nationkey = nc.n_nationkey
join region rs on ns.n_regionkey = rs.r_regionkey
"""

VIEWS["weather"] = """
select o_orderkey as oid, o_orderdate::date as weather_date, r_name as city, r_name as region, 'XX' as country,
  0::double as latitude, 0::double as longitude, o_orderdate::date::varchar as local_time,
  (o_orderkey % 35)::double as temp_c, (o_orderkey % 35)::double * 1.8::double + 32::double as temp_f,
  (40 + o_custkey % 60)::int as humidity,
  if(o_orderpriority <= '2-HIGH', o_custkey % 70, o_custkey % 50)::double as wind_kph, 'N' as wind_direction,
  (990 + o_orderkey % 40)::double as pressure_mb,
  if(o_orderpriority <= '2-HIGH', o_orderkey % 13, o_orderkey % 9)::double as precip_mm,
  if(o_orderpriority <= '2-HIGH', o_orderkey % 97, o_orderkey % 80)::int as cloud_coverage,
  case when o_orderkey % 11 = 0 then null
       when o_orderpriority <= '2-HIGH' then (o_orderkey % 15)::double
       when o_orderpriority = '5-LOW' then (3 + o_orderkey % 3)::double
       else (5 + o_orderkey % 10)::double end as visibility_km,
  case o_orderpriority
       when '1-URGENT' then if(o_orderkey % 2 = 0, 'Thunderstorm', 'Heavy snow')
       when '2-HIGH' then if(o_orderkey % 2 = 0, 'Patchy rain', 'Blizzard')
       when '3-MEDIUM' then if(o_orderkey % 2 = 0, 'Partly cloudy', 'Overcast')
       when '4-NOT SPECIFIED' then if(o_orderkey % 2 = 0, 'Sunny', 'Clear')
       else if(o_orderkey % 7 = 0, null, 'Fog') end as condition,
  if(o_orderpriority = '3-MEDIUM', 60 + o_custkey % 41, o_custkey % 101)::int as chance_of_rain
from orders
join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey
join region on n_regionkey = r_regionkey
"""

VIEWS["delays"] = """
select date '1998-01-01' + (ts::date - date '2024-01-01')::int as report_date, event_id as incident_id, user_id,
  event_type || case when value > 150 then ' critical' when value > 100 then ' URGENT' else '' end as incident_title,
  case when k % 10 <> 0 then k % 2 = 1 end as is_resolved
from (select *, json_extract_string(props, '$.k')::int as k from events)
"""

VIEWS["stg_flights"] = """
select * exclude (origin_city, d, a) replace (
    d as departure_delay_min, a as arrival_delay_min,
    coalesce(map {'landed': 'completado', 'scheduled': 'programado', 'active': 'en_vuelo', 'cancelled': 'cancelado'}
      [lower(flight_status)], 'desconocido') as flight_status),
  d > 15 as tiene_retraso,
  case when d = 0 then 'sin_retraso' when d > 180 then 'critico' when d > 60 then 'severo' when d > 15 then 'moderado'
       else 'menor' end as severidad_retraso
from (select *, ifnull(departure_delay_min, 0) as d, ifnull(arrival_delay_min, 0) as a from flights)
where flight_date is not null and flight_number is not null
"""

VIEWS["stg_weather"] = """
select *,
  case when visibility_km is null or visibility_km < 2 then 'muy_baja' when visibility_km < 5 then 'reducida'
       when visibility_km < 10 then 'buena' else 'excelente' end as visibilidad_categoria,
  case when wind_kph is null or wind_kph >= 60 then 'muy_fuerte' when wind_kph >= 40 then 'fuerte'
       when wind_kph >= 20 then 'moderado' else 'calma' end as viento_categoria,
  case when temp_c is null or temp_c >= 28 then 'calido' when temp_c >= 20 then 'templado'
       when temp_c >= 10 then 'fresco' else 'frio' end as temperatura_categoria,
  ifnull(visibility_km < 2, false) or ifnull(wind_kph > 60, false) or ifnull(precip_mm > 10, false)
    or ifnull(cloud_coverage > 90, false) as condiciones_adversas
from weather where weather_date is not null
"""

VIEWS["stg_delays"] = """
select *,
  case when regexp_matches(incident_title, 'critical|urgent', 'i') then 'alta'
       when regexp_matches(incident_title, 'error|fail|issue', 'i') then 'media' else 'baja' end as prioridad,
  if(ifnull(is_resolved, false), 'resuelto', 'pendiente') as estado_incidente
from delays where report_date is not null
"""

VIEWS["int_flights_daily"] = """
select flight_date, count(*) as total_vuelos,
  count(*) filter (flight_status = 'completado') as vuelos_completados,
  count(*) filter (flight_status = 'cancelado') as vuelos_cancelados,
  count(*) filter (flight_status = 'programado') as vuelos_programados,
  count(*) filter (flight_status = 'en_vuelo') as vuelos_en_vuelo,
  count(*) filter (tiene_retraso) as vuelos_con_retraso,
  round((100.0 * count(*) filter (tiene_retraso) / count(*))::decimal(18,6), 2)::double as pct_vuelos_con_retraso,
  round(avg(departure_delay_min)::decimal(18,6), 1)::double as avg_retraso_salida_min,
  round(avg(arrival_delay_min)::decimal(18,6), 1)::double as avg_retraso_llegada_min,
  max(departure_delay_min) as max_retraso_salida_min,
  count(*) filter (severidad_retraso = 'menor') as retrasos_menores,
  count(*) filter (severidad_retraso = 'moderado') as retrasos_moderados,
  count(*) filter (severidad_retraso = 'severo') as retrasos_severos,
  count(*) filter (severidad_retraso = 'critico') as retrasos_criticos,
  count(distinct airline_iata) as num_aerolineas,
  count(distinct departure_iata) as num_aeropuertos_origen,
  count(distinct arrival_iata) as num_aeropuertos_destino,
  round((100.0 * count(*) filter (flight_status = 'completado') / count(*))::decimal(18,6), 2)::double
    as pct_vuelos_completados
from stg_flights group by flight_date
"""

VIEWS["int_weather_daily"] = """
select weather_date, city, country,
  round(avg(temp_c)::decimal(18,6), 1)::double as avg_temp_c,
  round(avg(temp_f)::decimal(18,6), 1)::double as avg_temp_f,
  round(avg(humidity)::decimal(18,6), 0)::double as avg_humidity,
  round(avg(wind_kph)::decimal(18,6), 1)::double as avg_wind_kph,
  round(avg(visibility_km)::decimal(18,6), 1)::double as avg_visibility_km,
  round(avg(chance_of_rain)::decimal(18,6), 0)::double as avg_chance_of_rain,
  round(avg(pressure_mb)::decimal(18,6), 1)::double as avg_pressure_mb,
  max(temp_c) as max_temp_c, min(temp_c) as min_temp_c, max(wind_kph) as max_wind_kph, max(precip_mm) as max_precip_mm,
  max(cloud_coverage) as max_cloud_coverage, max(condition) as condicion_predominante,
  max(condiciones_adversas::int) as hubo_condiciones_adversas,
  max(visibilidad_categoria) as visibilidad_categoria, max(viento_categoria) as viento_categoria,
  max(temperatura_categoria) as temperatura_categoria, count(*) as num_mediciones
from stg_weather group by weather_date, city, country
"""

VIEWS["int_delays_daily"] = """
select report_date, count(*) as total_incidentes,
  count(*) filter (is_resolved) as incidentes_resueltos,
  count(*) filter (not is_resolved) as incidentes_pendientes,
  count(*) filter (prioridad = 'alta') as incidentes_alta_prioridad,
  count(*) filter (prioridad = 'media') as incidentes_media_prioridad,
  count(*) filter (prioridad = 'baja') as incidentes_baja_prioridad,
  round((100.0 * count(*) filter (is_resolved) / count(*))::decimal(18,6), 2)::double as pct_resolucion,
  round((100.0 * count(*) filter (prioridad = 'alta' and not is_resolved)
    / nullif(count(*) filter (prioridad = 'alta'), 0))::decimal(18,6), 2)::double as pct_criticos_sin_resolver,
  count(distinct user_id) as num_agentes_activos
from stg_delays group by report_date
"""

VIEWS["incidents_per_day"] = """
select report_date, count(*) as total_incidentes, count(*) filter (is_resolved) as incidentes_resueltos,
  count(*) filter (prioridad = 'alta') as incidentes_alta_prioridad,
  100.0::double * count(*) filter (is_resolved) / count(*) as pct_resolucion
from stg_delays group by report_date
"""

VIEWS["dim_fecha"] = """
select fecha, year(fecha)::int as anio, month(fecha)::int as mes, day(fecha)::int as dia,
  dayofweek(fecha)::int + 1 as dia_semana_num,
  ['Domingo','Lunes','Martes','Miercoles','Jueves','Viernes','Sabado'][dayofweek(fecha) + 1] as nombre_dia,
  ['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre']
    [month(fecha)] as nombre_mes,
  'Q' || quarter(fecha) as trimestre, dayofweek(fecha) in (0, 6) as es_fin_de_semana,
  week(fecha)::int as semana_anio, strftime(fecha, '%d/%m/%Y') as fecha_display
from (select flight_date as fecha from stg_flights union select weather_date from stg_weather
      union select report_date from stg_delays)
"""

VIEWS["airline_metrics"] = """
select airline_iata, count(*) as total_vuelos_historico, count(*) filter (tiene_retraso) as total_retrasos_historico,
  round((100.0 * count(*) filter (tiene_retraso) / count(*))::decimal(18,6), 2)::double as pct_retraso_historico,
  round(avg(departure_delay_min)::decimal(18,6), 1)::double as avg_retraso_historico_min,
  count(*) filter (flight_status = 'cancelado') as total_cancelaciones,
  min(flight_date) as primera_operacion, max(flight_date) as ultima_operacion
from stg_flights where airline_iata is not null group by airline_iata
"""

VIEWS["dim_aerolinea"] = """
select names.airline_iata, names.airline_name, m.* exclude (airline_iata),
  case when pct_retraso_historico <= 10 then 'alta' when pct_retraso_historico <= 25 then 'media' else 'baja' end
    as confiabilidad
from (select distinct airline_iata, airline_name from stg_flights where airline_iata is not null) names
left join airline_metrics m using (airline_iata)
"""

VIEWS["origin_metrics"] = """
select departure_iata as airport_iata, count(*) as vuelos_como_origen,
  round((100.0 * count(*) filter (tiene_retraso) / count(*))::decimal(18,6), 2)::double as pct_retraso_como_origen
from stg_flights where departure_iata is not null group by 1
"""

VIEWS["destination_metrics"] = """
select arrival_iata as airport_iata, count(*) as vuelos_como_destino,
  round((100.0 * count(*) filter (tiene_retraso) / count(*))::decimal(18,6), 2)::double as pct_retraso_como_destino
from stg_flights where arrival_iata is not null group by 1
"""

VIEWS["airport_names"] = """
select departure_iata as airport_iata, departure_airport as airport_name from stg_flights where departure_iata is not null
union select arrival_iata, arrival_airport from stg_flights where arrival_iata is not null
"""

VIEWS["dim_aeropuerto"] = """
select airport_iata, airport_name, ifnull(vuelos_como_origen, 0) as vuelos_como_origen,
  ifnull(vuelos_como_destino, 0) as vuelos_como_destino,
  ifnull(vuelos_como_origen, 0) + ifnull(vuelos_como_destino, 0) as total_movimientos,
  ifnull(pct_retraso_como_origen, 0) as pct_retraso_como_origen,
  ifnull(pct_retraso_como_destino, 0) as pct_retraso_como_destino
from airport_names left join origin_metrics using (airport_iata) left join destination_metrics using (airport_iata)
"""

VIEWS["airport_cities"] = """
select n_name as airport_iata, r_name as ciudad from nation join region on n_regionkey = r_regionkey
"""

VIEWS["condition_metrics"] = """
select condition, count(*) as frecuencia,
  round(avg(visibility_km)::decimal(18,6), 1)::double as avg_visibility_km,
  round(avg(wind_kph)::decimal(18,6), 1)::double as avg_wind_kph,
  round(avg(chance_of_rain)::decimal(18,6), 0)::double as avg_chance_of_rain,
  round(avg(temp_c)::decimal(18,6), 1)::double as avg_temp_c,
  max(condiciones_adversas::int) as genera_condiciones_adversas
from stg_weather group by condition
"""

VIEWS["dim_condicion_clima"] = """
select c.condicion_texto, m.* exclude (condition),
  case when genera_condiciones_adversas = 1 then 'alto'
       when avg_chance_of_rain > 60 or avg_visibility_km < 5 then 'medio' else 'bajo' end as impacto_operativo,
  ifnull((select label from (values (1, 'rain', 'lluvia'), (2, 'cloud', 'nublado'), (3, 'sun', 'soleado'),
      (4, 'clear', 'despejado'), (5, 'fog', 'niebla'), (6, 'storm', 'tormenta'), (7, 'snow', 'nieve'))
      words(rank, word, label) where contains(lower(c.condicion_texto), word) order by rank limit 1), 'otro')
    as grupo_condicion
from (select distinct condition as condicion_texto from stg_weather where condition is not null) c
left join condition_metrics m on m.condition = c.condicion_texto
"""

VIEWS["fct_lean"] = """
select f.flight_date as fecha, year(f.flight_date)::int as anio, month(f.flight_date)::int as mes,
  day(f.flight_date)::int as dia, dayofweek(f.flight_date)::int + 1 as dia_semana,
  total_vuelos, vuelos_completados, vuelos_cancelados, vuelos_con_retraso, pct_vuelos_con_retraso,
  avg_retraso_salida_min, avg_retraso_llegada_min, max_retraso_salida_min, num_aerolineas,
  avg_temp_c, avg_humidity, avg_wind_kph, avg_visibility_km, avg_chance_of_rain, max_precip_mm,
  hubo_condiciones_adversas, condicion_predominante, visibilidad_categoria, viento_categoria, temperatura_categoria,
  ifnull(d.total_incidentes, 0) as total_incidentes, ifnull(d.incidentes_resueltos, 0) as incidentes_resueltos,
  ifnull(d.incidentes_alta_prioridad, 0) as incidentes_alta_prioridad,
  ifnull(d.pct_resolucion, 0) as pct_resolucion_incidentes,
  pct_vuelos_con_retraso > 30 or vuelos_cancelados > 5 or ifnull(hubo_condiciones_adversas, 0) = 1 as dia_critico
from int_flights_daily f
left join int_weather_daily w on w.weather_date = f.flight_date
left join incidents_per_day d on d.report_date = f.flight_date
"""

VIEWS["fct_full"] = """
select f.flight_date as fecha, w.city as ciudad_clima, w.condicion_predominante as condicion_clima,
  year(f.flight_date)::int as anio, month(f.flight_date)::int as mes, day(f.flight_date)::int as dia,
  dayofweek(f.flight_date)::int + 1 as dia_semana,
  ['Domingo','Lunes','Martes','Miercoles','Jueves','Viernes','Sabado'][dayofweek(f.flight_date) + 1] as nombre_dia,
  dayofweek(f.flight_date) in (0, 6) as es_fin_de_semana,
  f.* exclude (flight_date), w.* exclude (weather_date, city, country, condicion_predominante, max_cloud_coverage,
    num_mediciones), w.num_mediciones as mediciones_clima,
  ifnull(total_incidentes, 0) as total_incidentes, ifnull(incidentes_resueltos, 0) as incidentes_resueltos,
  ifnull(incidentes_pendientes, 0) as incidentes_pendientes,
  ifnull(incidentes_alta_prioridad, 0) as incidentes_alta_prioridad,
  ifnull(incidentes_media_prioridad, 0) as incidentes_media_prioridad,
  ifnull(incidentes_baja_prioridad, 0) as incidentes_baja_prioridad,
  ifnull(pct_resolucion, 0) as pct_resolucion_incidentes,
  ifnull(pct_criticos_sin_resolver, 0) as pct_criticos_sin_resolver,
  ifnull(num_agentes_activos, 0) as num_agentes_activos,
  pct_vuelos_con_retraso > 30 or vuelos_cancelados > 5 or ifnull(hubo_condiciones_adversas, 0) = 1
    or ifnull(incidentes_alta_prioridad, 0) > 3 as dia_critico,
  round((pct_vuelos_completados * 0.5 + (100 - pct_vuelos_con_retraso) * 0.3
    + ifnull(pct_resolucion, 100) * 0.2)::decimal(18,6), 1)::double as score_rendimiento,
  ifnull(hubo_condiciones_adversas, 0) = 1 and pct_vuelos_con_retraso > 20 as clima_impacto_operaciones
from int_flights_daily f
left join int_weather_daily w on w.weather_date = f.flight_date
left join int_delays_daily d on d.report_date = f.flight_date
"""

VIEWS["fct_clima_diario"] = """
select weather_date as fecha, city as ciudad, max(condition) as condicion_predominante,
  bool_or(condiciones_adversas) as hubo_condiciones_adversas,
  round(avg(temp_c)::decimal(18,6), 1)::double as avg_temp_c,
  round(avg(humidity)::decimal(18,6), 0)::double as avg_humidity,
  round(avg(wind_kph)::decimal(18,6), 1)::double as avg_wind_kph,
  round(avg(chance_of_rain)::decimal(18,6), 0)::double as avg_chance_of_rain,
  round(avg(cloud_coverage)::decimal(18,6), 1)::double as avg_cloud,
  max(precip_mm) as max_precip_mm, count(*) as num_mediciones
from stg_weather group by 1, 2
"""

VIEWS["fct_vuelos"] = """
select f.flight_date as fecha, departure_iata as origen_iata, arrival_iata as destino_iata, airline_name,
  lower(f.flight_status) as flight_status, departure_delay_min as retraso_salida_min,
  ifnull(departure_delay_min > 15, false) as tiene_retraso, c.condicion_predominante as condicion_clima,
  ifnull(c.hubo_condiciones_adversas, false) as condiciones_adversas
from flights f left join fct_clima_diario c on c.fecha = f.flight_date and c.ciudad = f.origin_city
"""

VIEWS["fct_incidentes"] = """
select incident_id as incidente_id, report_date as fecha,
  'Supplier#' || lpad((d.user_id % 10)::varchar, 9, '0') as airline_name, event_type as motivo, d.user_id as agente_id,
  is_resolved, if(ifnull(is_resolved, false), 'resuelto', 'pendiente') as estado,
  floor(value)::int as minutos_retraso_asociado,
  case when is_resolved then (1 + incident_id % 5)::double end as satisfaccion_cliente,
  case when is_resolved then (1 + incident_id % 48)::double end as tiempo_resolucion_horas
from delays d join events e on e.event_id = d.incident_id
"""


def with_views(query: str) -> str:
    """``query`` preceded by the views it needs, directly or through other views."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b(?:from|join)\s+{name}\b", text):
                needed.add(name)
                visit(VIEWS[name])

    visit(query)
    if not needed:
        return query.strip()
    parts = [f"{name} as ({VIEWS[name].strip()})" for name in VIEWS if name in needed]
    return "with " + ",\n".join(parts) + "\n" + query.strip()
