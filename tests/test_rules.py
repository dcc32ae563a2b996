"""Boundary values of the classification rules."""

import pytest
from pyspark.sql import functions as F

from vuelometria.functions import calendar, numeric, rules, text


def column(spark, values, kind):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_delay_severity_and_late(spark):
    df = column(spark, [None, -5, 0, 1, 15, 16, 60, 61, 180, 181], "int")
    assert apply(df, rules.delay_severity("v")) == [
        "sin_retraso", "menor", "sin_retraso", "menor", "menor", "moderado", "moderado", "severo", "severo", "critico",
    ]
    assert apply(df, rules.is_late("v")) == [False] * 5 + [True] * 5


def test_visibility(spark):
    df = column(spark, [None, 1.9, 2.0, 4.9, 5.0, 9.9, 10.0], "double")
    assert apply(df, rules.visibility_class("v")) == [
        "muy_baja", "muy_baja", "reducida", "reducida", "buena", "buena", "excelente",
    ]


def test_wind(spark):
    df = column(spark, [None, 19.9, 20.0, 40.0, 60.0, 60.1], "double")
    assert apply(df, rules.wind_class("v")) == ["muy_fuerte", "calma", "moderado", "fuerte", "muy_fuerte", "muy_fuerte"]


def test_temperature(spark):
    df = column(spark, [None, 9.9, 10.0, 20.0, 28.0], "double")
    assert apply(df, rules.temperature_class("v")) == ["calido", "frio", "fresco", "templado", "calido"]


ADVERSE = [
    ((None, None, None, None), False),
    ((2.0, None, None, None), False),
    ((1.9, None, None, None), True),
    ((None, 60.0, None, None), False),
    ((None, 60.1, None, None), True),
    ((None, None, 10.0, None), False),
    ((None, None, 10.1, None), True),
    ((None, None, None, 90), False),
    ((None, None, None, 91), True),
    ((10.0, 5.0, 0.0, 91), True),
]


def test_adverse(spark):
    schema = "i int, visibility_km double, wind_kph double, precip_mm double, cloud_coverage int"
    df = spark.createDataFrame([(i, *row) for i, (row, _) in enumerate(ADVERSE)], schema)
    assert apply(df, rules.is_adverse()) == [expected for _, expected in ADVERSE]


def test_status(spark):
    df = column(spark, ["Landed", "SCHEDULED", "active", "cancelled", "diverted", None], "string")
    assert apply(df, rules.decode_status("v")) == [
        "completado", "programado", "en_vuelo", "cancelado", "desconocido", "desconocido",
    ]


def test_priority(spark):
    df = column(spark, ["CRITICAL error", "urgent", "Failure", "issue", "an error", "hello", None], "string")
    labels = apply(df, text.classify_text("v", text.PRIORITY_KEYWORDS, text.PRIORITY_DEFAULT))
    assert labels == ["alta", "alta", "media", "media", "media", "baja", "baja"]


def test_condition_group(spark):
    df = column(spark, ["Thunderstorm with rain", "PARTLY CLOUDY", "Lluvia ligera", "Sunny", "Snowstorm", None], "string")
    labels = apply(df, text.classify_text("v", text.CONDITION_KEYWORDS, text.CONDITION_DEFAULT))
    assert labels == ["lluvia", "nublado", "otro", "soleado", "tormenta", "otro"]


def test_reliability(spark):
    df = column(spark, [10.0, 10.01, 25.0, 25.01, None], "double")
    assert apply(df, rules.reliability("v")) == ["alta", "media", "media", "baja", "baja"]


@pytest.mark.parametrize("form, high", [("lean", False), ("full", True)])
def test_critical_day(spark, form, high):
    rows = [
        (0, 30.0, 5, None, None), (1, 30.01, 5, 0, None), (2, 30.0, 6, 0, None), (3, 0.0, 0, 1, None),
        (4, 0.0, 0, 0, 3), (5, 0.0, 0, 0, 4),
    ]
    df = spark.createDataFrame(
        rows,
        "i int, pct_vuelos_con_retraso double, vuelos_cancelados bigint, hubo_condiciones_adversas int, "
        "incidentes_alta_prioridad bigint",
    )
    assert apply(df, rules.critical_day(form=form)) == [False, True, True, True, False, high]


def test_state_keeps_null_pending(spark):
    df = column(spark, [True, False, None], "boolean")
    assert apply(df, rules.incident_state("v")) == ["resuelto", "pendiente", "pendiente"]


def test_score_and_impact(spark):
    df = spark.createDataFrame(
        [(0, 80.0, 10.0, None, 1), (1, 80.0, 20.01, 50.0, 1), (2, 80.0, 20.01, 50.0, None)],
        "i int, done double, late double, solved double, adverse int",
    )
    assert apply(df, rules.performance_score("done", "late", "solved")) == [87.0, 74.0, 74.0]
    assert apply(df, rules.weather_impact("adverse", "late")) == [False, True, False]


def test_rounding_of_ties(spark):
    df = column(spark, [62.35, 1.25, -1.25, 0.05, None], "double")
    assert apply(df, numeric.round_n("v", 1)) == [62.4, 1.3, -1.3, 0.1, None]
    assert apply(df, text.fmt_decimals("v", 1)) == ["62.4", "1.3", "-1.3", "0.1", None]


def test_percent_of_nothing(spark):
    df = spark.createDataFrame([(0, 1, 0), (1, 1, 3), (2, 1, None)], "i int, a bigint, b bigint")
    assert apply(df, numeric.pct("a", "b")) == [None, 33.33, None]
    assert apply(df, numeric.ratio("a", "b"))[0] is None


def test_text_formats(spark):
    df = column(spark, [1234567, 999, None], "bigint")
    assert apply(df, text.fmt_thousands("v")) == ["1,234,567", "999", None]
    assert apply(df, text.join_text(F.lit("a"), "v", F.lit("b"))) == ["a1234567b", "a999b", "ab"]


def test_bucketize_needs_matching_labels():
    with pytest.raises(ValueError):
        numeric.bucketize("v", (1, 2), ("a", "b"))


def test_calendar_against_python(spark):
    """The 86 days from 1 April 2026 on, computed by the standard library."""
    import datetime

    first = datetime.date(2026, 4, 1)
    days = [first + datetime.timedelta(n) for n in range(86)]
    df = spark.createDataFrame([(d,) for d in days], "fecha date")
    rows = {r["fecha"]: r for r in df.select("fecha", *calendar.calendar_columns("fecha")).collect()}
    names = ["Lunes", "Martes", "Miercoles", "Jueves", "Viernes", "Sabado", "Domingo"]
    months = {4: "Abril", 5: "Mayo", 6: "Junio"}
    for d in days:
        row = rows[d]
        assert (row["anio"], row["mes"], row["dia"]) == (d.year, d.month, d.day)
        assert row["dia_semana_num"] == d.isoweekday() % 7 + 1
        assert row["nombre_dia"] == names[d.weekday()]
        assert row["nombre_mes"] == months[d.month]
        assert row["trimestre"] == "Q2"
        assert row["es_fin_de_semana"] == (d.weekday() >= 5)
        assert row["semana_anio"] == d.isocalendar()[1]
        assert row["fecha_display"] == d.strftime("%d/%m/%Y")


def test_rankings_keep_what_has_no_value(spark):
    from vuelometria.operators.topn import top_with_ties

    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 2.0 + 1e-9), ("d", 2.0), ("e", None)], "k string, v double")
    names = lambda n, **how: sorted(r["k"] for r in top_with_ties(df, "v", n, **how).collect())
    assert names(1) == ["c", "d"] and names(3) == names(9) == ["a", "c", "d"]
    assert names(3, keep_null=True) == ["a", "c", "d"] and names(4, keep_null=True) == ["a", "b", "c", "d", "e"]


def test_large_numbers(spark):
    from vuelometria.functions.numeric import round_n
    from vuelometria.functions.text import fmt_decimals, fmt_thousands
    from vuelometria.operators.topn import top_with_ties

    df = spark.createDataFrame([(1e12,), (1e15 + 0.5,), (1e40,)], "v double")
    assert [r[0] for r in df.select(round_n("v", 2)).collect()] == [1e12, 1e15 + 0.5, 1e40]
    small = df.where("v < 1e20")
    assert [tuple(r) for r in small.select(fmt_decimals("v", 1), fmt_thousands("v")).collect()] == [
        ("1000000000000.0", "1,000,000,000,000"), ("1000000000000000.5", "1,000,000,000,000,001"),
    ]
    assert top_with_ties(df, "v", 1).count() == 1 and top_with_ties(df, "v", 3).count() == 3
