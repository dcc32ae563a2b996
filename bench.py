"""Headline queries, timed: prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local cores. Every result is
computed in full and dropped by the ``noop`` sink; a query counts with the better of two runs.
"""

from __future__ import annotations

import json
import os
import time

from vuelometria.checks import QUERIES
from vuelometria.session import build_session

HEADLINE = (
    "h1_stg_flights", "h2_stg_weather", "h3_stg_delays", "h4_int_flights_daily", "h5_int_weather_daily",
    "h6_int_delays_daily", "h7_dim_fecha", "h8_dim_aerolinea", "h9_dim_aeropuerto", "h10_dim_condicion_clima",
    "h11_fct_lean", "h12_fct_full", "c8_flight_weather", "d13_mode", "i_vuelos_by", "i_incidentes_by", "j1_rutas",
    "j2_aerolineas_retraso", "j5_destinos", "j7_dia_semana", "j9_control", "j12_temperatura", "j17_aerolinea_condicion",
    "j19_alertas", "j22_correlacion", "j24_motivos", "j26_acumulada", "j28_reclamos", "j32_detalle", "j33_bullet",
)
RUNS = 2


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for key in HEADLINE:
        best = float("inf")
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        seconds[key] = round(best, 3)
    spark.stop()
    scale = os.path.basename(folder).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
