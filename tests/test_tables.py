"""CSV files, catalog tables, counters and the session."""

import pytest
from pyspark.sql import functions as F

from vuelometria.operators.payload import payload
from vuelometria.session import scratch_dir
from vuelometria.sources import tables
from vuelometria.sources.schemas import STAR_CSV
from vuelometria.streaming.ingest import feed_counts

CSV = {
    "dim_fecha": ("2031-11-08,2031,11,8,7,Sabado,Noviembre,Q4,True,45,08/11/2031", "es_fin_de_semana", True),
    "dim_aerolinea": ("U1,Uno,100,10,10.0,12.5,3,2026-04-01,2026-06-25,alta", "pct_retraso_historico", 10.0),
    "dim_aeropuerto": ("XQZ,Campo Norte,Villa Azul,Nortelandia,812,790,1602,3.25,4.75", "ciudad", "Villa Azul"),
    "dim_condicion_clima": ("Granizo leve,otro,alto,1,1.5,70.5,90,-2.5,6", "frecuencia", 6),
    "fct_clima_diario": (
        "2031-11-08,Villa Azul,Nortelandia,Granizo leve,otro,alto,False,-2.5,27.5,41,70.5,1.5,90,6.5,998.0,1.0,-6.0,99.5,3",
        "hubo_condiciones_adversas",
        False,
    ),
}


@pytest.mark.parametrize("name", list(STAR_CSV))
def test_star_csv(spark, tmp_path, name):
    line, column, value = CSV[name]
    header = ",".join(part.split()[0] for part in STAR_CSV[name].split(","))
    (tmp_path / f"{name}.csv").write_text(f"{header}\n{line}\n", encoding="utf-8")
    rows = tables.read_star_csv(spark, str(tmp_path / f"{name}.csv"), name).collect()
    assert len(rows) == 1 and rows[0][column] == value and None not in rows[0]


def test_counter_reads_the_input_once(spark, tmp_path):
    counts = feed_counts()
    a, b = spark.range(7), spark.range(3)
    counts.watch("flights", a).write.parquet(str(tmp_path / "a"))
    counts.watch("weather", b).write.parquet(str(tmp_path / "b"))
    assert counts.rows == {"flights": 7, "weather": 3}


def test_views_answer_sql(spark):
    names = tables.register_views(spark, {"uno": spark.range(3)}, prefix="prueba_")
    assert names == ["prueba_uno"]
    assert spark.sql("select sum(id) as s from prueba_uno").collect()[0]["s"] == 3


def test_scratch_uses_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second and first.startswith(shared)


def test_payload_text(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), ("c", 3)], "k string, v int")
    text = payload(df, ["k", "v"], ["v desc"], header={"tipo": "t"}).collect()[0]["payload"]
    assert text == '{"tipo":"t","data":"c:3|a:1|b:"}'
    assert payload(df, ["k", F.col("v") * 2], ["k"], sep="~").collect()[0]["data"] == "a~2|b~|c~6"
