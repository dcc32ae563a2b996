"""Shape of the physical plans, and behaviour when one key holds most of the rows."""

import contextlib
import datetime
import glob

import pytest
from pyspark.sql import functions as F

from vuelometria.checks import QUERIES
from vuelometria.plans import daily, facts, staging
from vuelometria.sources import tables
from vuelometria.sources.schemas import PROCESSED

#: Queries that write feeds or tables before they return.
EAGER = ("a", "h13", "h14", "h15")
#: One row per date goes through the single ordered window of a running total.
RUNNING = {"e2_running_total", "j26_acumulada"}
LAZY = [k for k in QUERIES if not k.startswith(EAGER)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **conf):
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("key", LAZY)
def test_operators(spark, folder, key):
    text = plan(QUERIES[key](spark, folder))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "Python" not in text and "InPandas" not in text
    unpartitioned = [line for line in text.splitlines() if "Window [" in line and "windowspecdefinition(" in line]
    unpartitioned = [line for line in unpartitioned if line.rstrip().split("], ")[-1].startswith("[")]
    if key not in RUNNING:
        for line in unpartitioned:
            assert "iata" in line, line


@pytest.fixture(scope="module")
def processed(spark, folder, tmp_path_factory):
    from vuelometria.plans.binding import BoundTables

    path = str(tmp_path_factory.mktemp("processed") / "flights")
    bound = BoundTables(spark, folder)
    rows = bound.flights.drop("origin_city").where("year(flight_date) = 1998").withColumn(
        "ingested_at", F.current_timestamp()
    )
    tables.write_partitioned(rows, path, "flight_date", balance=False)
    return path


def test_date_filter_prunes_partitions_and_columns(spark, processed):
    flights = tables.read_processed(spark, processed, "flights")
    day = staging.stg_flights(flights).where(F.col("flight_date") == datetime.date(1998, 3, 1))
    text = daily.flight_volumes(day)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(flight_date" in text
    schema = text.rsplit("ReadSchema: ", 1)[1].splitlines()[0]
    assert "flight_status" in schema and "airline_name" not in schema and "airport" not in schema
    assert "IsNotNull(flight_number)" in text


def test_ranking_runs_the_aggregation_once(spark, folder):
    for key in ("j1_rutas", "j2_aerolineas_retraso", "j5_destinos", "j24_motivos"):
        df = QUERIES[key](spark, folder)
        df.collect()
        assert "ReusedExchange" in plan(df), key


def test_latest_rows_read_only_their_partitions(spark, processed):
    from vuelometria.operators.topn import latest_with_ties

    flights = tables.read_processed(spark, processed, "flights")
    last = latest_with_ties(flights, "flight_date", 10)
    rows = last.collect()
    text = plan(last)
    assert "PartitionFilters: [isnotnull(flight_date" in text and "Subquery" in text.split("PartitionFilters", 1)[1]
    newest = sorted((r[0] for r in flights.select("flight_date").collect()), reverse=True)
    assert sorted(r["flight_date"] for r in rows) == sorted(d for d in newest if d >= newest[9])


def hot_rows(spark, n):
    """Nine of ten rows fall on one date and city."""
    day = F.when(F.col("id") % 10 < 9, F.lit("2026-04-01")).otherwise(
        F.date_add(F.lit("2026-04-02").cast("date"), (F.col("id") % 7).cast("int"))
    )
    return spark.range(n).select(
        day.cast("date").alias("flight_date"),
        F.lit("Landed").alias("flight_status"),
        F.concat(F.lit("A"), F.col("id") % 5).alias("departure_iata"),
        F.lit("B").alias("arrival_iata"),
        F.lit("Uno").alias("airline_name"),
        (F.col("id") % 40).cast("int").alias("departure_delay_min"),
        F.lit("Medellin").alias("origin_city"),
        F.sha2(F.col("id").cast("string"), 256).alias("padding"),
    )


def test_hot_date_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "t")
    with settings(
        spark,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="256KB",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="64KB",
    ):
        tables.write_partitioned(hot_rows(spark, 60_000).repartition(16), path, "flight_date")
    files = {d: len(glob.glob(f"{path}/flight_date={d}/*.parquet")) for d in ("2026-04-01", "2026-04-08")}
    assert files["2026-04-01"] >= 4 and files["2026-04-08"] <= 2
    assert spark.read.parquet(path).count() == 60_000


def test_hot_key_join_is_split(spark):
    clima = spark.createDataFrame(
        [(datetime.date(2026, 4, d), "Medellin", f"c{d}", d % 2 == 1) for d in range(1, 9)],
        "fecha date, ciudad string, condicion_predominante string, hubo_condiciones_adversas boolean",
    )
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="16KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="16KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    ):
        joined = facts.fct_vuelos(hot_rows(spark, 60_000).repartition(16), clima)
        rows = joined.select("condicion_clima", "condiciones_adversas", "retraso_salida_min")
        result = rows.collect()
        assert "skew=true" in plan(rows)
    assert len(result) == 60_000
    assert sum(r["condicion_clima"] == "c1" and r["condiciones_adversas"] for r in result) == 54_000


def test_hot_date_model_equals_brute_force(spark):
    stg = staging.stg_flights(
        hot_rows(spark, 20_000).select(
            "*", F.lit("x").alias("flight_number"), F.lit("U1").alias("airline_iata"),
            *[F.lit(None).cast("string").alias(c) for c in (
                "departure_airport", "departure_scheduled", "arrival_airport", "arrival_scheduled")],
            F.lit(None).cast("int").alias("arrival_delay_min"),
        )
    )
    row = daily.int_flights_daily(stg).where("flight_date = date '2026-04-01'").collect()[0]
    delays = [i % 40 for i in range(20_000) if i % 10 < 9]
    assert row["total_vuelos"] == len(delays) == row["vuelos_completados"]
    assert row["vuelos_con_retraso"] == sum(d > 15 for d in delays)
    assert row["avg_retraso_salida_min"] == round(sum(delays) / len(delays), 1)
    assert (row["num_aerolineas"], row["num_aeropuertos_origen"], row["num_aeropuertos_destino"]) == (1, 5, 1)


def test_schemas_end_with_the_partition_column():
    for name, column in tables.PARTITION.items():
        assert PROCESSED[name].replace("\n", " ").strip().split(",")[-1].split()[0] == column
