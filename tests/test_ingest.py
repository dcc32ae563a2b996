"""Feeds: odd documents, incremental runs, isolation, the daily job."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from vuelometria.plans import daily_run
from vuelometria.plans.daily_run import run_daily
from vuelometria.sources import raw, tables
from vuelometria.streaming.ingest import FeedError, FeedPaths, ingest_incremental, run_feeds

FLIGHT = {
    "flight_date": "2026-04-01",
    "flight_status": "Landed",
    "departure": {"airport": "El Dorado", "iata": "BOG", "scheduled": "2026-04-01T10:00:00", "delay": 20},
    "arrival": {"airport": "Jose Maria Cordova", "iata": "MDE", "scheduled": "2026-04-01T11:00:00", "delay": None},
    "airline": {"name": "Aerolinea Uno", "iata": "U1"},
    "flight": {"number": "101"},
}
WEATHER = {
    "location": {
        "name": "Medellin", "region": "Antioquia", "country": "Colombia", "lat": 6.29, "lon": -75.54,
        "localtime": "2026-04-01 9:05",
    },
    "current": {
        "temp_c": 22, "temp_f": 71.6, "humidity": 80, "wind_kph": 61.0, "wind_dir": "N", "pressure_mb": 1012.0,
        "precip_mm": 0.2, "cloud": 75, "vis_km": 10.0, "condition": {"text": "Partly cloudy"}, "chance_of_rain": 60,
    },
}
INCIDENT = {"userId": 1, "id": 7, "title": "critical error", "completed": True}


def put(base, feed, name, document):
    folder = base / "raw" / feed
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(document if isinstance(document, str) else json.dumps(document))


def flight(**changes):
    return {**FLIGHT, **changes}


def test_flight_documents(spark, tmp_path):
    records = [
        FLIGHT,
        flight(flight_date="not a date"),
        flight(flight_status="CANCELLED", departure=None),
        flight(departure={"iata": "CLO", "delay": 12.0}),
        flight(departure={"iata": "CLO", "delay": "soon"}),
    ]
    put(tmp_path, "flights", "flights_2026-04-01_17-00-00.json", {"pagination": {}, "data": records})
    put(tmp_path, "flights", "flights_2026-04-02_17-00-00.json", {"data": []})
    put(tmp_path, "flights", "flights_2026-04-03_17-00-00.json", {"error": "limit"})
    documents = raw.read_flights_raw(spark, str(tmp_path / "raw/flights"))
    assert raw.explode_data(documents).count() == 5
    flat = raw.flatten_flights(documents)
    rows = [r.asDict() for r in flat.drop("ingested_at").collect()]
    assert [r["departure_delay_min"] for r in rows] == [20, 20, None, 12, None]
    assert [r["flight_date"] for r in rows] == [datetime.date(2026, 4, 1), None] + [datetime.date(2026, 4, 1)] * 3
    assert rows[2]["departure_iata"] is None and rows[2]["arrival_iata"] == "MDE"
    assert rows[0]["arrival_delay_min"] is None and rows[0]["flight_number"] == "101"


def test_weather_documents(spark, tmp_path):
    put(tmp_path, "weather", "weather_2026-04-01_17-00-00.json", WEATHER)
    put(tmp_path, "weather", "weather_2026-04-02_17-00-00.json", [WEATHER, {"location": {"name": "Cali"}}])
    rows = raw.flatten_weather(raw.read_weather_raw(spark, str(tmp_path / "raw/weather"))).collect()
    assert sorted((r["city"], r["temp_c"], r["weather_date"]) for r in rows if r["temp_c"]) == [
        ("Medellin", 22.0, datetime.date(2026, 4, 1))
    ] * 2
    assert [r["weather_date"] for r in rows if r["city"] == "Cali"] == [None]
    assert {r["condition"] for r in rows} == {"Partly cloudy", None}


def test_incident_documents(spark, tmp_path):
    put(tmp_path, "delays", "delays_2026-04-01_17-00-00.json", [INCIDENT, {"userId": 2, "id": 8, "title": "urgent"}])
    put(tmp_path, "delays", "other.json", [{"id": 9}])
    documents = raw.read_delays_raw(spark, str(tmp_path / "raw/delays"))
    rows = {r["incident_id"]: r for r in raw.flatten_delays(documents, as_of="2026-05-05").collect()}
    assert rows[7]["is_resolved"] is True and rows[8]["is_resolved"] is None
    assert rows[8]["report_date"] == datetime.date(2026, 4, 1)
    assert rows[9]["report_date"] == datetime.date(2026, 5, 5)


def test_torn_document_fails_or_is_skipped(spark, tmp_path):
    put(tmp_path, "flights", "a.json", {"data": [FLIGHT]})
    put(tmp_path, "flights", "b.json", '{"data": [{"flight_date": "2026')
    path = str(tmp_path / "raw/flights")
    with pytest.raises(Exception, match="not a JSON document"):
        raw.read_flights_raw(spark, path).collect()
    assert raw.explode_data(raw.read_flights_raw(spark, path, broken="skip")).count() == 1


TORN = {
    "flights": ('{"data": [{"flight_date": "2026', '{"data": [{"flight_date": "2026-04-01"}'),
    "weather": ('{"location": ', '[{"location": {"name": "Cali"}}, {"location": {"name": "Cali"}}'),
    "delays": ('[{"userId": 1, "ti', '[{"userId": 1, "id": 2, "title": "x"}'),
}
GOOD = {"flights": {"data": [FLIGHT]}, "weather": WEATHER, "delays": [INCIDENT]}
KEYS = {"flights": "flight_number", "weather": "city", "delays": "incident_title"}


@pytest.mark.parametrize("feed", list(TORN))
@pytest.mark.parametrize("where", ["middle", "end", "empty"])
def test_torn_pull_of_every_feed(spark, tmp_path, feed, where):
    put(tmp_path, feed, f"{feed}_2026-04-01_17-00-00.json", GOOD[feed])
    put(tmp_path, feed, f"{feed}_2026-04-02_17-00-00.json", {"middle": TORN[feed][0], "end": TORN[feed][1], "empty": ""}[where])
    paths = paths_of(tmp_path, feed)
    documents = raw.read_raw(spark, feed, paths.raw)
    known = raw.flatten(feed, documents).where(F.col(KEYS[feed]).isNotNull())
    if where == "empty":  # a file without content has no document
        assert known.count() == 1 and ingest_incremental(spark, feed, paths) == 1
        return
    for _ in range(2):
        with pytest.raises(Exception, match="not a JSON document"):
            known.collect()
        with pytest.raises(Exception, match="not a JSON document"):
            ingest_incremental(spark, feed, paths)
    put(tmp_path, feed, f"{feed}_2026-04-02_17-00-00.json", GOOD[feed])
    assert ingest_incremental(spark, feed, paths) == 2
    assert tables.read_processed(spark, paths.processed, feed).count() == 2
    assert ingest_incremental(spark, feed, paths) == 0


def test_quarantine_takes_bad_documents_and_lets_good_ones_land(spark, tmp_path):
    where = [str(tmp_path / d) for d in ("raw", "out", "ck", "aside")]
    put(tmp_path, "delays", "delays_2026-04-01_17-00-00.json", [INCIDENT] * 3)
    put(tmp_path, "delays", "delays_2026-04-02_17-00-00.json", TORN["delays"][0])
    paths = {"delays": FeedPaths.below("delays", *where)}
    (report,) = run_feeds(spark, paths)
    assert (report.rows, report.quarantined, report.error) == (3, 1, None)
    put(tmp_path, "delays", "delays_2026-04-03_17-00-00.json", [INCIDENT])
    (report,) = run_feeds(spark, paths)
    assert (report.rows, report.quarantined) == (1, 0)
    aside = spark.read.parquet(f"{where[3]}/delays").collect()
    assert len(aside) == 1 and aside[0]["document"] == TORN["delays"][0] and aside[0]["file_path"].endswith("02_17-00-00.json")


def test_a_batch_that_died_after_its_write_is_not_doubled(spark, tmp_path):
    paths = paths_of(tmp_path, "delays")
    put(tmp_path, "delays", "delays_2026-04-01_17-00-00.json", [INCIDENT] * 3)
    assert ingest_incremental(spark, "delays", paths) == 3
    # rows of a batch writer stay, and the commit of the batch is taken back as if the run had died before it
    tables.write_partitioned(tables.read_processed(spark, paths.processed, "delays").limit(2), paths.processed, "report_date")
    for commit in (tmp_path / "ck/delays/commits").glob("*0*"):
        commit.unlink()
    assert ingest_incremental(spark, "delays", paths) == 3
    assert tables.read_processed(spark, paths.processed, "delays").count() == 5


def test_a_retry_on_other_dates_with_a_changed_file_is_exact(spark, tmp_path):
    # no date in the name of the pull: its rows get the date of the run
    old = [{**INCIDENT, "id": i} for i in range(3)]
    put(tmp_path, "delays", "kept_2026-03-01_17-00-00.json", old)
    place = paths_of(tmp_path, "delays")
    ingest_incremental(spark, "delays", place, as_of="2026-03-01")
    put(tmp_path, "delays", "pull.json", [{**INCIDENT, "id": i} for i in range(10, 15)])
    put(tmp_path, "delays", "more_2026-03-01_18-00-00.json", [{**INCIDENT, "id": 20}])
    assert ingest_incremental(spark, "delays", place, as_of="2026-04-01") == 6
    for commit in (tmp_path / "ck/delays/commits").glob("*1*"):
        commit.unlink()
    put(tmp_path, "delays", "pull.json", [{**INCIDENT, "id": i} for i in range(11, 16)])
    assert ingest_incremental(spark, "delays", place, as_of="2026-04-02") == 6
    rows = spark.read.parquet(f"{place.processed}").select("incident_id", "report_date").collect()
    assert sorted((r.incident_id, str(r.report_date)) for r in rows) == sorted(
        [(i, "2026-03-01") for i in (0, 1, 2, 20)] + [(i, "2026-04-02") for i in range(11, 16)]
    )


def test_a_retry_reads_only_the_dates_concerned(spark, tmp_path, monkeypatch):
    from vuelometria.streaming import ingest

    schema = "incident_id long, report_date date"
    history = spark.range(40).selectExpr("id as incident_id", "date_add(date'2026-01-01', cast(id as int)) as report_date")
    path, ledger = str(tmp_path / "t"), str(tmp_path / "ledger")
    ingest._append_once(history, path, "report_date", ledger, "batch-0", True)
    rows = spark.createDataFrame([(99, datetime.date(2026, 1, 3))], schema)
    ingest._append_once(rows, path, "report_date", ledger, "batch-1", True)
    seen = []
    stored = ingest.scratch_dir
    monkeypatch.setattr(ingest, "scratch_dir", lambda spark, label: seen.append(stored(spark, label)) or seen[-1])
    ingest._append_once(rows, path, "report_date", ledger, "batch-1", True)
    assert spark.read.parquet(seen[1]).select("incident_id").collect() == [(2,)]
    assert spark.read.parquet(path).count() == 41


def test_ids_of_64_bits(spark, tmp_path):
    put(tmp_path, "delays", "d.json", [{"userId": 2**40, "id": 2**60}, {"userId": "7", "id": 8.0}, {"userId": "x", "id": None}])
    rows = raw.flatten_delays(raw.read_delays_raw(spark, str(tmp_path / "raw/delays"))).select("user_id", "incident_id").collect()
    assert [tuple(r) for r in rows] == [(2**40, 2**60), (7, 8), (None, None)]


ODD = {
    "numbers as text": '[{"userId": 12.50, "id": 1e3, "title": 7}, {"id": 9007199254740993.0, "title": {"a" : [1.0,  2]}}, {"title": true}]',
    "pretty": '[\r\n  {\n "id": "a",\n\n "title": "x\\ny"}\n, {"completed": "no"}]\n\n',
    "one object": '{"id": 1, "title": "t", "other": [1]}',
    "two values": '[{"id": 1}] [{"id": 2}]',
    "byte order mark": "\ufeff" + '[{"title": "m\u00e1s"}]',
    "blank": " \n\n ",
    "empty array": "[]",
    "torn at the end": '[{"id": 1},\n {"id": 2',
    "no JSON": "a\nb\n",
    "wrong kind": '[{"id": [1, 2], "title": null, "completed": 3}, {"id": 2, "completed": true}]',
}


def test_documents_read_whole_are_those_of_the_multi_line_reader(spark, tmp_path):
    for name, text in ODD.items():
        put(tmp_path, "delays", f"{name}.json", text)
    path = str(tmp_path / "raw/delays")
    plain = {"multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": raw.CORRUPT}

    def rows(options):
        documents = spark.read.schema(raw.RAW["delays"]).options(**options).json(path)
        return sorted(repr(tuple(r)) for r in documents.withColumn("file", F.col("_metadata.file_name")).collect())

    # split files as well: a document stays with the task that has its start
    expected = rows(plain)
    assert rows(raw.RAW_OPTIONS) == expected and len(expected) > 10
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16")
    try:
        assert rows(raw.RAW_OPTIONS) == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_document_is_read_once(spark, tmp_path):
    put(tmp_path, "delays", "d.json", [{"userId": i, "id": i, "title": "t"} for i in range(5000)])
    size = (tmp_path / "raw/delays/d.json").stat().st_size

    def taken():
        return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics() if s.getScheme() == "file")

    documents = raw.flatten_delays(raw.read_delays_raw(spark, str(tmp_path / "raw/delays")))
    before = taken()
    assert documents.agg(F.sum("incident_id")).first()[0] == sum(range(5000))
    assert taken() - before < 3 * size


def test_pulls_that_share_dates_become_a_file_per_date(spark, folder):
    from vuelometria.checks import QUERIES

    small = {"spark.sql.execution.arrow.maxRecordsPerBatch": "20", "spark.sql.files.maxPartitionBytes": "8KB"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        table = QUERIES["h13_etl_flights"](spark, folder)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(table.inputFiles()) == table.select("flight_date").distinct().count()


def test_landed_pulls_are_small_beside_their_text(spark, folder, tmp_path):
    from vuelometria.checks.feeds import land_feed
    from vuelometria.plans.binding import BoundTables

    path = land_feed(BoundTables(spark, folder), "flights", str(tmp_path / "flights"))
    pulls = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").text(path)
    text = pulls.agg(F.sum(F.length("value"))).first()[0]
    assert sum(f.stat().st_size for f in (tmp_path / "flights").rglob("part-*")) < text / 3


def paths_of(tmp_path, feed):
    return FeedPaths.below(feed, str(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "ck"))


def test_second_run_takes_only_new_files(spark, tmp_path):
    paths = paths_of(tmp_path, "delays")
    put(tmp_path, "delays", "delays_2026-04-01_17-00-00.json", [INCIDENT] * 3)
    assert ingest_incremental(spark, "delays", paths) == 3
    assert ingest_incremental(spark, "delays", paths) == 0
    put(tmp_path, "delays", "delays_2026-04-02_17-00-00.json", [INCIDENT] * 2)
    assert ingest_incremental(spark, "delays", paths) == 2
    table = tables.read_processed(spark, paths.processed, "delays")
    counts = {r[0].isoformat(): r[1] for r in table.groupBy("report_date").count().collect()}
    assert counts == {"2026-04-01": 3, "2026-04-02": 2}


def test_many_pulls_of_a_day_become_few_files(spark, tmp_path):
    for i in range(40):
        put(tmp_path, "delays", f"delays_2026-04-01_10-00-{i:02d}.json", [INCIDENT] * 5)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8KB")
    try:
        for balance, files in ((True, 1), (False, 40)):
            paths = FeedPaths(str(tmp_path / "raw/delays"), str(tmp_path / f"o{balance}"), str(tmp_path / f"c{balance}"))
            assert ingest_incremental(spark, "delays", paths, balance=balance) == 200
            assert len(list((tmp_path / f"o{balance}/report_date=2026-04-01").glob("*.parquet"))) == files
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_broken_feed_does_not_stop_the_others(spark, tmp_path):
    put(tmp_path, "flights", "f.json", {"data": [FLIGHT]})
    put(tmp_path, "weather", "w.json", '{"location": ')
    put(tmp_path, "delays", "d.json", [INCIDENT])
    paths = {feed: paths_of(tmp_path, feed) for feed in ("flights", "weather", "delays")}
    with pytest.raises(FeedError) as failure:
        run_feeds(spark, paths, as_of="2026-04-01")
    reports = {r.feed: r for r in failure.value.reports}
    assert (reports["flights"].rows, reports["delays"].rows) == (1, 1)
    assert reports["weather"].error and "weather" in str(failure.value)
    # once the file is mended the same run goes through, and the others add nothing
    put(tmp_path, "weather", "w.json", WEATHER)
    assert [r.rows for r in run_feeds(spark, paths)] == [0, 1, 0]


def test_dynamic_overwrite_keeps_other_dates(spark, tmp_path):
    df = spark.createDataFrame([(1, "2026-04-01"), (2, "2026-04-02")], "x int, d string").withColumn("d", F.to_date("d"))
    path = str(tmp_path / "t")
    tables.write_partitioned(df, path, "d")
    back = tables.materialize(df.where("x = 2").withColumn("x", F.lit(9)), path, "d")
    assert sorted(r["x"] for r in back.collect()) == [1, 9]


def test_daily_job_recomputes_changed_dates_only(spark, tmp_path, monkeypatch):
    where = [str(tmp_path / d) for d in ("raw", "out", "curated", "ck")]
    cities = spark.createDataFrame([("BOG", "Medellin")], "airport_iata string, ciudad string")

    def curated(name):
        return daily_run.curated_table(spark, where[2], name)

    put(tmp_path, "flights", "f1.json", {"data": [FLIGHT, flight(flight_status="cancelled")]})
    put(tmp_path, "weather", "w1.json", WEATHER)
    put(tmp_path, "delays", "delays_2026-04-01_17-00-00.json", [INCIDENT])
    first = run_daily(spark, *where, cities=cities)
    assert {r.feed: r.rows for r in first.feeds} == {"flights": 2, "weather": 1, "delays": 1}
    fact = curated("fct_flights_analytics").collect()
    assert len(fact) == 1 and fact[0]["vuelos_cancelados"] == 1 and fact[0]["dia_critico"] is True
    assert fact[0]["pct_resolucion_incidentes"] == 100.0
    assert curated("fct_vuelos").where("condiciones_adversas and condicion_clima = 'Partly cloudy'").count() == 2

    # a late record for the old date, and a new date
    put(tmp_path, "flights", "f2.json", {"data": [FLIGHT, flight(flight_date="2026-04-02")]})
    second = run_daily(spark, *where, since=first.started_at, cities=cities)
    assert {r.feed: r.rows for r in second.feeds} == {"flights": 2, "weather": 0, "delays": 0}
    totals = {r["fecha"].isoformat(): r["total_vuelos"] for r in curated("fct_flights_analytics").collect()}
    assert totals == {"2026-04-01": 3, "2026-04-02": 1}
    assert curated("dim_aerolinea").collect()[0]["total_vuelos_historico"] == 4
    assert curated("dim_fecha").count() == 2
    assert curated("fct_vuelos").count() == 4

    # weather that comes late reaches the flights of its date, and only those
    late = json.loads(json.dumps(WEATHER).replace("2026-04-01", "2026-04-02").replace("Partly cloudy", "Fog"))
    put(tmp_path, "weather", "w2.json", late)
    slack = daily_run.CLOCK_SLACK
    monkeypatch.setattr(daily_run, "CLOCK_SLACK", datetime.timedelta(0))
    third = run_daily(spark, *where, since=datetime.datetime.now(datetime.timezone.utc), cities=cities)
    monkeypatch.setattr(daily_run, "CLOCK_SLACK", slack)
    assert third.changed == {"flights": [], "weather": [datetime.date(2026, 4, 2)], "delays": []}
    conditions = {(r["fecha"].day, r["condicion_clima"]) for r in curated("fct_vuelos").collect()}
    assert conditions == {(1, "Partly cloudy"), (2, "Fog")}
    assert curated("fct_vuelos").count() == 4 and curated("int_weather_daily").count() == 2

    # nothing new: the same tables again
    later = datetime.datetime.now(datetime.timezone.utc) + datetime.timedelta(hours=2)
    last = run_daily(spark, *where, since=later, cities=cities)
    assert last.changed == {"flights": [], "weather": [], "delays": []}
    assert {r["total_vuelos"] for r in curated("fct_flights_analytics").collect()} == {3, 1}


def test_every_visual_runs_on_what_the_daily_job_wrote(spark, tmp_path):
    from vuelometria.plans.visuals import VISUALS, visual

    where = [str(tmp_path / d) for d in ("raw", "out", "curated", "ck")]
    put(tmp_path, "flights", "f1.json", {"data": [FLIGHT, flight(flight_status="cancelled", airline={"name": "Dos", "iata": "D2"})]})
    put(tmp_path, "weather", "w1.json", WEATHER)
    put(tmp_path, "delays", "delays_2026-04-01_17-00-00.json", [INCIDENT, {**INCIDENT, "id": 8, "completed": False}])
    cities = spark.createDataFrame([("BOG", "Medellin")], "airport_iata string, ciudad string")
    cases = spark.createDataFrame(
        [(7, "Aerolinea Uno", "equipaje", 35, 4.0, 6.0)],
        "incident_id long, airline_name string, motivo string, minutos_retraso_asociado int, "
        "satisfaccion_cliente double, tiempo_resolucion_horas double",
    )
    first = run_daily(spark, *where, cities=cities, cases=cases)
    put(tmp_path, "delays", "delays_2026-04-02_17-00-00.json", [{**INCIDENT, "id": 9}])
    run_daily(spark, *where, since=first.started_at, cities=cities, cases=cases)
    read = {n: daily_run.curated_table(spark, where[2], n) for n in
            ("fct_vuelos", "fct_incidentes", "fct_clima_diario", "dim_fecha", "dim_aeropuerto")}
    assert read["fct_incidentes"].count() == 3
    facts = {n: df for n, df in read.items() if n.startswith("fct")}
    dims = {n: df for n, df in read.items() if n.startswith("dim")}
    rows = {name: visual(name)(facts, dims).collect() for name in VISUALS}
    assert [(r["motivo"], r["total"]) for r in rows["p3_v2_motivos"] if r["motivo"]] == [("equipaje", 1)]
    assert len(rows["p1_v2_aerolineas_retraso"]) == 2 and len(rows["p3_v10_detalle"]) == 3


def test_daily_job_without_weather(spark, tmp_path):
    where = [str(tmp_path / d) for d in ("raw", "out", "curated", "ck")]
    put(tmp_path, "flights", "f1.json", {"data": [FLIGHT]})
    put(tmp_path, "weather", "w1.json", "{")
    put(tmp_path, "delays", "d.json", [INCIDENT])
    with pytest.raises(FeedError):
        run_daily(spark, *where, as_of="2026-04-01")
    row = spark.read.parquet(f"{where[2]}/fct_flights_lean").collect()[0]
    assert row["avg_temp_c"] is None and row["total_incidentes"] == 1


def test_models_of_a_feed_that_never_came(spark, tmp_path):
    processed, curated = str(tmp_path / "out"), str(tmp_path / "curated")
    put(tmp_path, "flights", "f1.json", {"data": [FLIGHT]})
    ingest_incremental(spark, "flights", paths_of(tmp_path, "flights"))
    assert daily_run.run_models(spark, processed, curated) == {"flights": None, "weather": None, "delays": None}
    recently = datetime.datetime.now(datetime.timezone.utc)
    changed = daily_run.run_models(spark, processed, curated, since=recently)
    assert changed == {"flights": [datetime.date(2026, 4, 1)], "weather": [], "delays": []}
    assert spark.read.parquet(f"{curated}/fct_flights_analytics").collect()[0]["total_incidentes"] == 0


def test_command_line(spark, tmp_path, capsys):
    from vuelometria.__main__ import main

    where = [str(tmp_path / d) for d in ("raw", "out", "curated", "ck")]
    put(tmp_path, "flights", "f1.json", {"data": [FLIGHT]})
    put(tmp_path, "weather", "w1.json", [WEATHER, {**WEATHER, "location": {**WEATHER["location"], "name": "Cali"}}])
    put(tmp_path, "delays", "d.json", [INCIDENT])
    main([*where, "--as-of", "2026-04-01", "--city", "Medellin"])
    assert "weather: 2 rows" in capsys.readouterr().out
    fact = spark.read.parquet(f"{where[2]}/fct_flights_analytics").collect()
    assert [r["ciudad_clima"] for r in fact] == ["Medellin"]
