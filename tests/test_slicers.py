"""A slicer on the calendar opens the partitions of its dates only."""

import datetime

from pyspark.sql import functions as F

from vuelometria.plans.visuals import visual
from vuelometria.sources.tables import write_partitioned

from test_history import spoil

FLIGHT = "fecha date, origen_iata string, destino_iata string, airline_name string, flight_status string, retraso_salida_min int, tiene_retraso boolean"


def test_a_year_of_the_calendar_prunes_the_facts(spark, tmp_path):
    place = str(tmp_path / "fct_vuelos")
    dates = [datetime.date(y, m, 1) for y in (2024, 2025, 2026) for m in (1, 2, 3, 4)]
    rows = [(d, "AAA", "BBB", "Uno", "landed", 20, True) for d in dates for _ in range(3)]
    write_partitioned(spark.createDataFrame(rows, FLIGHT), place, "fecha")
    calendar = spark.createDataFrame([(d, d.year) for d in dates], "fecha date, anio int")
    calendar.write.parquet(str(tmp_path / "dim_fecha"))
    facts = {"fct_vuelos": spark.read.schema(FLIGHT).parquet(place)}
    dims = {"dim_fecha": spark.read.parquet(str(tmp_path / "dim_fecha"))}
    routes = visual("p1_v1_rutas")
    assert routes(facts, dims).first()["vuelos"] == 36
    assert spoil(f"{place}/fecha=2024-*/*.parquet") + spoil(f"{place}/fecha=2025-*/*.parquet") >= 8
    year = routes(facts, dims, where={"dim_fecha": F.col("anio") == 2026})
    assert year.first()["vuelos"] == 12
    assert "dynamicpruning" in year._jdf.queryExecution().toString()
