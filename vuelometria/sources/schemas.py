"""Schemas of the feeds, the processed tables and the star-schema CSVs."""

from __future__ import annotations

CORRUPT = "_corrupt_record"

# Numbers are read as double, whichever way a pull writes them, and cast afterwards; ids are read
# as text, because a double rounds them beyond 2^53. A value of
# the wrong kind becomes NULL and its record is kept; CORRUPT then holds the text of the document.
RAW = {
    "flights": f"""
        data array<struct<
            flight_date string, flight_status string,
            departure struct<airport string, iata string, scheduled string, delay double>,
            arrival struct<airport string, iata string, scheduled string, delay double>,
            airline struct<name string, iata string>,
            flight struct<number string>>>,
        {CORRUPT} string""",
    "weather": f"""
        location struct<name string, region string, country string, lat double, lon double, localtime string>,
        current struct<temp_c double, temp_f double, humidity double, wind_kph double, wind_dir string,
            pressure_mb double, precip_mm double, cloud double, vis_km double,
            condition struct<text string>, chance_of_rain double>,
        {CORRUPT} string""",
    "delays": f"userId string, id string, title string, completed boolean, {CORRUPT} string",
}

#: Partition column of every processed table.
PARTITION = {"flights": "flight_date", "weather": "weather_date", "delays": "report_date"}

PROCESSED = {
    "flights": """
        flight_status string, departure_airport string, departure_iata string, departure_scheduled string,
        departure_delay_min int, arrival_airport string, arrival_iata string, arrival_scheduled string,
        arrival_delay_min int, airline_name string, airline_iata string, flight_number string,
        ingested_at timestamp, flight_date date""",
    "weather": """
        city string, region string, country string, latitude double, longitude double, local_time string,
        temp_c double, temp_f double, humidity int, wind_kph double, wind_direction string, pressure_mb double,
        precip_mm double, cloud_coverage int, visibility_km double, condition string, chance_of_rain int,
        ingested_at timestamp, weather_date date""",
    "delays": """
        user_id bigint, incident_id bigint, incident_title string, is_resolved boolean,
        ingested_at timestamp, report_date date""",
}

STAR_CSV = {
    "dim_fecha": """
        fecha date, anio int, mes int, dia int, dia_semana_num int, nombre_dia string, nombre_mes string,
        trimestre string, es_fin_de_semana boolean, semana_anio int, fecha_display string""",
    "dim_aerolinea": """
        airline_iata string, airline_name string, total_vuelos_historico int, total_retrasos_historico int,
        pct_retraso_historico double, avg_retraso_historico_min double, total_cancelaciones int,
        primera_operacion date, ultima_operacion date, confiabilidad string""",
    "dim_aeropuerto": """
        airport_iata string, airport_name string, ciudad string, pais string, vuelos_como_origen int,
        vuelos_como_destino int, total_movimientos int, pct_retraso_como_origen double,
        pct_retraso_como_destino double""",
    "dim_condicion_clima": """
        condicion_texto string, grupo_condicion string, impacto_operativo string,
        genera_condiciones_adversas int, avg_visibility_km double, avg_wind_kph double,
        avg_chance_of_rain int, avg_temp_c double, frecuencia int""",
    "fct_clima_diario": """
        fecha date, ciudad string, pais string, condicion_predominante string, grupo_condicion string,
        impacto_operativo string, hubo_condiciones_adversas boolean, avg_temp_c double, avg_temp_f double,
        avg_humidity int, avg_wind_kph double, avg_visibility_km double, avg_chance_of_rain int,
        max_precip_mm double, avg_pressure_mb double, max_temp_c double, min_temp_c double,
        max_wind_kph double, num_mediciones int""",
}
