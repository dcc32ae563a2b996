import datetime
import random
import statistics

import pytest
from pyspark.sql import functions as F

from vuelometria.checks.registry import bound_tables
from vuelometria.operators.bitmaps import BUCKET, Codes, codes_of, daily_state, distinct_over, new_codes
from vuelometria.operators.moments import correlation, merged_moments, moment_state, sigma
from vuelometria.operators.prefix import prefix_sums
from vuelometria.plans import daily
from vuelometria.plans.daily_run import dictionary


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- distinct counts


@pytest.mark.parametrize("spread", [1, 9_000])
def test_distinct_over_any_days(spark, spread):
    r = random.Random(spread)
    rows = [(r.randint(1, 6), r.choice((None, *(f"v{i}" for i in range(40)))), r.choice("xyz")) for _ in range(600)]
    df = spark.createDataFrame(rows, "day int, a string, b string")
    codes = {}
    for c, times in (("a", spread), ("b", 1)):
        numbered = [(x.value, x.code * times) for x in new_codes(df.select(c)).collect()]
        codes[c] = codes_of(spark.createDataFrame(numbered, "value string, code long"))
    assert codes["a"].single == (spread == 1) and codes["b"].single
    state = daily_state(df, ["day"], codes, {"n": F.count(F.lit(1))})
    assert sum(x.n for x in state.collect()) == 600
    names = {"a": "na", "b": "nb"}
    for days in ({1, 2}, {3, 4, 5, 6}, set(range(7))):
        chosen = [x for x in rows if x[0] in days]
        got = distinct_over(state.where(F.col("day").isin(*days)).withColumn("k", F.lit(1)), ["k"], names).first()
        assert (got.na, got.nb) == (len({x[1] for x in chosen} - {None}), len({x[2] for x in chosen}))
    per_day = {x.day: x.na for x in distinct_over(state, ["day"], names).collect()}
    assert per_day == {d: len({x[1] for x in rows if x[0] == d} - {None}) for d in {x[0] for x in rows}}


def test_codes_are_dense_and_stay(spark, tmp_path):
    first = spark.createDataFrame([(f"v{i % 700}",) for i in range(2000)] + [(None,)], "x string")
    codes = dictionary(first, str(tmp_path / "dict"))
    known = {x.value: x.code for x in codes.frame.collect()}
    assert sorted(known.values()) == list(range(700)) and codes.bound == 700
    more = dictionary(spark.createDataFrame([("v5",), ("new",), ("newer",)], "x string"), str(tmp_path / "dict"))
    after = {x.value: x.code for x in more.frame.collect()}
    assert {k: after[k] for k in known} == known and sorted(after[k] for k in ("new", "newer")) == [700, 701]
    assert dictionary(first, str(tmp_path / "dict")).bound == 702


def test_daily_flights_read_the_records_once(spark, folder):
    t = bound_tables(spark, folder)
    plan = plan_of(t.int_flights_daily)
    assert plan.count("lineitem.parquet") == 1 and "Expand" not in plan
    assert plan.count("Exchange hashpartitioning(flight_date") == 1
    want = daily.int_flights_daily(t.stg_flights)
    got = t.int_flights_daily.select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_daily_flights_with_a_large_dictionary(spark, folder):
    t = bound_tables(spark, folder)
    wide = {c: Codes(x.frame.withColumn("code", F.col("code") * BUCKET), x.bound * BUCKET) for c, x in t.flight_codes.items()}
    want = daily.int_flights_daily(t.stg_flights)
    got = daily.int_flights_daily(t.stg_flights, codes=wide).select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


# ---- moments


def test_moments_at_large_values(spark):
    r = random.Random(2)
    rows = [(k, g, 1e9 + r.random(), 1e9 + r.random() if r.random() < 0.9 else None) for k in "ab" for g in range(20) for _ in range(r.randint(0, 30))]
    rows += [("c", 1, None, 2.0), ("d", 1, 5.0, 5.0), ("d", 2, 5.0, 6.0)]
    df = spark.createDataFrame(rows, "k string, g int, x double, y double")
    state = moment_state(df, ["k", "g"], {"x": "x", "y": "y"}, [("x", "y"), ("x", "x")])
    merged = {m.k: m for m in merged_moments(state, ["k"], ["x__y", "x__x"]).select("k", sigma("x__x").alias("s"), correlation("x__y").alias("r")).collect()}
    for k in "ab":
        xs = [x - 1e9 for a, _, x, _ in rows if a == k]
        both = [(x - 1e9, y - 1e9) for a, _, x, y in rows if a == k and y is not None]
        assert merged[k].s == pytest.approx(statistics.pstdev(xs), rel=1e-6)
        assert merged[k].r == pytest.approx(statistics.correlation(*zip(*both)), abs=1e-6)
    assert merged["c"].r is None and merged["c"].s is None and merged["d"].s == 0 and merged["d"].r is None
    whole = merged_moments(state, [], ["x__x"]).select(sigma("x__x").alias("s")).first().s
    assert whole == pytest.approx(statistics.pstdev([x - 1e9 for *_, x, _ in rows if x is not None]), rel=1e-6)


# ---- running totals


@pytest.mark.parametrize("ranges", [None, 1, 7])
def test_prefix_sums(spark, ranges):
    r = random.Random(3)
    rows = [(r.choice((None, *range(40))), i, r.choice((None, *range(-9, 9))), "t") for i in range(500)] + [(-1, 500, None, "t")]
    df = spark.createDataFrame(rows, "day int, n int, v long, __v string")
    got = prefix_sums(df.withColumnRenamed("__v", "other"), ["day", "n"], ["v"], ranges)
    total, want = None, {}
    for day, n, v, _ in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        total = v if total is None else total + (v or 0)
        want[n] = total
    assert {x.n: x.v_acum for x in got.collect()} == want
    assert "SinglePartition" not in plan_of(got)
    assert prefix_sums(df.limit(0).withColumnRenamed("__v", "other"), ["day", "n"], ["v"], ranges).collect() == []


def test_prefix_sums_equal_the_window(spark, folder):
    flights = bound_tables(spark, folder).stg_flights.select("flight_date", "flight_number", F.col("arrival_delay_min").cast("long").alias("v"))
    last = prefix_sums(flights, ["flight_date", "flight_number", "v"], ["v"]).agg(F.max_by("v_acum", F.struct("flight_date", "flight_number", "v"))).first()[0]
    assert last == flights.agg(F.sum("v")).first()[0] and isinstance(flights.first().flight_date, datetime.date)
