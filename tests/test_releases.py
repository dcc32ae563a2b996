"""Publication of table sets, replay of pulls, expectations, and modes from sketches."""

import datetime
import os
import random
from collections import Counter

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from vuelometria.operators.frequent import frequent_state, mode_over
from vuelometria.plans import daily_run
from vuelometria.plans.daily_run import curated_table, run_daily
from vuelometria.sources import raw, tables
from vuelometria.sources.releases import publish, published, releases, rollback
from vuelometria.streaming import ingest
from vuelometria.streaming.ingest import Expectation, FeedError, FeedReport, ingest_incremental, judged, replay

from test_ingest import FLIGHT, INCIDENT, WEATHER, flight, paths_of, put

UTC = datetime.timezone.utc


# ---- releases


def frames(spark, x):
    return {name: spark.createDataFrame([(x, name)], "x int, name string") for name in ("one", "two")}


def test_a_set_changes_at_once_and_old_releases_go(spark, tmp_path):
    root = str(tmp_path / "set")
    with pytest.raises(FileNotFoundError):
        published(spark, root, "one")
    first = publish(spark, root, frames(spark, 1))
    old = published(spark, root, "two", first)
    publish(spark, root, frames(spark, 2))
    assert [published(spark, root, n).first()["x"] for n in ("one", "two")] == [2, 2]
    assert old.first()["x"] == 1  # a reader of the earlier release goes on
    for x in (3, 4):
        publish(spark, root, frames(spark, x))
    assert [r.number for r in releases(spark, root)] == [2, 3, 4]
    assert len(os.listdir(f"{root}/_tables")) == 3
    rollback(spark, root)
    assert published(spark, root, "one").first()["x"] == 3
    assert publish(spark, root, frames(spark, 5)).number == 4
    assert published(spark, root, "two").first()["x"] == 5
    rollback(spark, root), rollback(spark, root)
    with pytest.raises(ValueError):
        rollback(spark, root)


def test_a_daily_run_killed_between_two_dimensions_leaves_the_old_set(spark, tmp_path, monkeypatch):
    where = [str(tmp_path / d) for d in ("raw", "out", "curated", "ck")]
    put(tmp_path, "flights", "f1.json", {"data": [FLIGHT]})
    put(tmp_path, "weather", "w1.json", WEATHER)
    put(tmp_path, "delays", "delays_2026-04-01_17-00-00.json", [INCIDENT])
    first = run_daily(spark, *where)
    names = ("dim_fecha", "dim_aerolinea", "dim_aeropuerto", "dim_condicion_clima")
    before = {n: sorted(curated_table(spark, where[2], n).collect()) for n in names}
    put(tmp_path, "flights", "f2.json", {"data": [flight(flight_date="2026-04-02", airline={"name": "Dos", "iata": "U2"})]})
    write = DataFrameWriter.parquet

    def dies(self, path, *args, **kwargs):
        if "dim_aeropuerto" in path:
            raise RuntimeError("killed")
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", dies)
    with pytest.raises(RuntimeError, match="killed"):
        run_daily(spark, *where, since=first.started_at)
    assert {n: sorted(curated_table(spark, where[2], n).collect()) for n in names} == before
    monkeypatch.setattr(DataFrameWriter, "parquet", write)
    run_daily(spark, *where, since=first.started_at)
    assert curated_table(spark, where[2], "dim_fecha").count() == 2
    assert curated_table(spark, where[2], "dim_aerolinea").count() == 2


# ---- replay


def landed(tmp_path, feed, name, at):
    os.utime(tmp_path / "raw" / feed / name, (at.timestamp(), at.timestamp()))


def test_replay_after_a_wrong_mapping(spark, tmp_path, monkeypatch):
    place = paths_of(tmp_path, "flights")
    now = datetime.datetime.now(UTC).replace(microsecond=0)
    days = [now - datetime.timedelta(days=d) for d in (9, 2, 1)]
    put(tmp_path, "flights", "f1.json", {"data": [flight(flight_date="2026-04-01")]})
    put(tmp_path, "flights", "f2.json", {"data": [flight(flight_date="2026-04-01"), flight(flight_date="2026-04-02")]})
    put(tmp_path, "flights", "f3.json", {"data": [flight(flight_date="2026-04-03"), flight(flight_date="no date")]})
    for name, at in zip(("f1.json", "f2.json", "f3.json"), days):
        landed(tmp_path, "flights", name, at)

    def wrong(feed, documents, *args):  # a mapping that sets dates off by ten days and loses the status
        flat = raw.flatten(feed, documents, *args)
        return flat.withColumn("flight_date", F.date_add("flight_date", 10)).withColumn("flight_status", F.lit(None).cast("string"))

    with monkeypatch.context() as patched:
        patched.setattr(ingest, "flatten", wrong)
        assert ingest_incremental(spark, "flights", place) == 5
    # rows of another writer, without a file
    other = raw.flatten("flights", raw.read_raw(spark, "flights", f"{place.raw}/f3.json"))
    tables.write_partitioned(other.where("flight_date is not null"), place.processed, "flight_date")

    def rows():
        df = tables.read_processed(spark, place.processed, "flights")
        return Counter((str(r["flight_date"]), r["flight_status"]) for r in df.collect())

    put(tmp_path, "flights", "f4.json", {"data": [flight(flight_date="2026-04-04")]})  # not taken before
    for _ in range(2):  # it can be repeated
        replay(spark, "flights", place, since=days[1])
        assert rows() == {
            ("2026-04-11", None): 1,  # the pull before the range stays as it was
            ("2026-04-01", "Landed"): 1, ("2026-04-02", "Landed"): 1, ("2026-04-03", "Landed"): 2, ("None", "Landed"): 1,
            ("2026-04-04", "Landed"): 1,
        }
    assert ingest_incremental(spark, "flights", place) == 0
    assert replay(spark, "flights", place, since=days[0], until=days[0]) == 1
    assert rows()["2026-04-01", "Landed"] == 2 and ("2026-04-11", None) not in rows()


def test_replay_of_a_range_without_pulls(spark, tmp_path):
    place = paths_of(tmp_path, "delays")
    put(tmp_path, "delays", "delays_2026-04-01_17-00-00.json", [INCIDENT])
    assert replay(spark, "delays", place, since=datetime.datetime.now(UTC) + datetime.timedelta(days=1)) == 0
    assert tables.read_processed(spark, place.processed, "delays").count() == 1


# ---- expectations


def test_expectations_warn_or_fail(spark, tmp_path):
    reports = [FeedReport("flights", 0), FeedReport("weather", 9, quarantined=2), FeedReport("delays", 0, "broken")]
    expect = {
        "flights": Expectation(), "weather": Expectation(max_rows=5, max_quarantined=1, fail=True), "delays": Expectation(),
    }
    flights, weather, delays = judged(reports, expect)
    assert flights.warning == "0 rows, at least 1 expected" and flights.error is None
    assert weather.error == "9 rows, at most 5 expected; 2 documents put aside, at most 1 expected"
    assert delays.error == "broken" and delays.warning is None
    assert judged(reports, {}) == reports

    where = [str(tmp_path / d) for d in ("raw", "out", "curated", "ck")]
    put(tmp_path, "flights", "f1.json", {"data": []})
    put(tmp_path, "weather", "w1.json", WEATHER)
    put(tmp_path, "delays", "delays_2026-04-01_17-00-00.json", [INCIDENT])
    with pytest.raises(FeedError, match="flights: 0 rows, at least 1 expected"):
        run_daily(spark, *where, expect={"flights": Expectation(fail=True), "delays": Expectation(min_rows=2)})
    assert curated_table(spark, where[2], "dim_fecha").count() == 1  # the models of the others are there


# ---- modes


def plain_mode(rows):
    out = {}
    for key in {k for k, _, _ in rows}:
        n = Counter(v for k, _, v in rows if k == key and v is not None)
        if n:
            top = max(n.values())
            out[key] = (min(v for v in n if n[v] == top), top)
    return out


@pytest.mark.parametrize("limit", [200_000, 0])
@pytest.mark.parametrize("kind", ["few", "ties", "rare", "just below", "copies"])
def test_mode_from_sketches(spark, kind, limit):
    r = random.Random(kind)
    rows = [(k, r.randint(1, 4), None) for k in ("a", "b", None)]
    for k in ("a", "b", None, "none"):
        if k == "none":
            rows.append((k, 1, None))
            continue
        n = 600
        if kind == "few":
            rows += [(k, r.randint(1, 4), r.choice("xxyz")) for _ in range(n)]
        elif kind == "ties":
            rows += [(k, i % 4, v) for i in range(20) for v in "zxy"]
        elif kind == "rare":  # all values once, so every one of them may be the mode
            rows += [(k, r.randint(1, 4), f"v{i}") for i in range(n)]
        elif kind == "just below":  # more than any other, and less than the sketch can vouch for
            rows += [(k, r.randint(1, 4), f"v{i}") for i in range(n)] + [(k, i, "w") for i in range(5)] + [(k, i, "u") for i in range(5)]
        else:
            rows += [(k, r.randint(1, 4), f"v{int(r.paretovariate(0.6))}") for _ in range(n)]
    df = spark.createDataFrame(rows, "k string, day int, v string")
    state = frequent_state(df, ["k", "day"], "v", tracked=32)
    for days in (range(9), (1, 2)):
        chosen = F.col("day").isin(*days)
        got = mode_over(state.where(chosen), df.where(chosen), ["k"], "v", tracked=32, broadcast_rows=limit)
        assert {x["k"]: (x["v"], x["frecuencia"]) for x in got.collect()} == plain_mode([x for x in rows if x[1] in days])


def test_mode_counts_the_candidates_only(spark, monkeypatch):
    df = spark.range(3_000).selectExpr("'a' as k", "id % 3 as day", "if(id % 5 = 0, 'w', cast(id as string)) as v")
    state = frequent_state(df, ["k", "day"], "v", tracked=64)

    def refuse(*args):
        raise AssertionError("all values were counted")

    monkeypatch.setattr("vuelometria.operators.frequent.mode_per_group", refuse)
    assert mode_over(state, df, ["k"], "v", tracked=64).collect() == [("a", "w", 600)]
    empty = df.where("false")
    assert mode_over(frequent_state(empty, ["k", "day"], "v"), empty, ["k"], "v").collect() == []
