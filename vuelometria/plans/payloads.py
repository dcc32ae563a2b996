"""Text payloads of the visuals: header entries and one string with all rows, as JSON text.

The rows come from ``visuals``; here is only how each visual writes them down.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fmt_date, fmt_decimals, fmt_thousands, join_text
from ..operators.payload import as_json, joined_rows
from .visuals import CLOSURE_TARGET, CORRELATED, VISUALS, visual

Piece = Column | str


@dataclass(frozen=True)
class Layout:
    """How a visual is written: header, the pieces of a row with their separators, row order."""

    #: None marks the place of a number.
    header: Mapping[str, str | None]
    pieces: Sequence[Piece]
    order: Sequence[str]
    #: False where the number of rows has no bound, like airlines or ties: every row stays a row of its own then.
    joined: bool = True
    #: Header entries without quotes that are computed from the rows.
    numbers: Mapping[str, Callable[[], Column]] = field(default_factory=dict)


def _row(*cells: Piece, sep: str = ":") -> list[Piece]:
    out: list[Piece] = []
    for i, cell in enumerate(cells):
        out += [F.lit(sep), cell] if i else [cell]
    return out


def _n(column: str, digits: int = 1) -> Column:
    return fmt_decimals(column, digits)


def _pair(first: str, second: str, value: Column) -> list[Piece]:
    return [first, F.lit("~"), second, F.lit(":"), value]


def _kpi_text() -> Column:
    kpi = F.col("kpi")
    return (
        F.when(kpi == "Satisfaccion", _n("valor", 2))
        .when(kpi == "CasosCerrados", _n("valor", 0))
        .when(kpi == "MinEvitados", fmt_thousands("valor"))
        .otherwise(_n("valor"))
    )


def _target_text() -> Column:
    return F.when(F.col("kpi") == "Satisfaccion", _n("meta", 1)).otherwise(_n("meta", 0))


def _layouts() -> dict[str, Layout]:
    shares = ["airline_name", *[_n(c) for c in ("pct_t", "pct_r", "pct_c")]]
    share_cols = "aerolinea:pct_tiempo:pct_retraso:pct_cancelado"
    by_share = ["pct_t desc", "airline_name"]
    return {
        "p1_v1_rutas": Layout(
            {"tipo": "mapa_rutas"},
            ["origen_iata", F.lit("→"), "destino_iata", F.lit(":"), "vuelos"],
            ["vuelos desc", "origen_iata", "destino_iata"],
            joined=False,
        ),
        "p1_v2_aerolineas_retraso": Layout(
            {"tipo": "barra_h", "titulo": "Top 10 Aerolíneas · Retraso Prom (min)"},
            _row("airline_name", _n("avg_ret")),
            ["avg_ret desc", "airline_name"],
        ),
        "p1_v3_barra_apilada": Layout(
            {"tipo": "barra_apilada100", "cols": share_cols}, _row(*shares), by_share, joined=False
        ),
        "p1_v4_embudo": Layout({"tipo": "funnel"}, _row("etapa", _n("valor", 0)), ["orden"]),
        "p1_v5_destinos": Layout(
            {"tipo": "treemap", "cols": "destino:vuelos:pct"},
            _row("destino_iata", "vuelos", _n("pct")),
            ["vuelos desc", "destino_iata"],
        ),
        "p1_v6_destino_aerolinea": Layout(
            {"tipo": "barra_agrupada", "ejes": "destino~aerolinea:avg_retraso"},
            _pair("destino_iata", "airline_name", _n("avg_ret")),
            ["destino_iata", "airline_name"],
            joined=False,
        ),
        "p1_v7_dia_semana": Layout(
            {"tipo": "heatmap", "cols": "dia:vuelos:retraso"},
            _row("nombre_dia", "vuelos", _n("retraso")),
            ["dia_semana_num"],
        ),
        "p1_v8_evolucion": Layout({"tipo": "linea"}, _row("fecha_display", "vuelos"), ["fecha"]),
        "p1_v9_control": Layout(
            {"tipo": "control_chart"},
            _row("fecha_display", _n("avg_ret")),
            ["fecha"],
            numbers={c: (lambda c=c: F.max(_n(c))) for c in ("lsc", "lic", "media")},
        ),
        "p1_v10_cancelaciones": Layout(
            {"tipo": "waterfall"}, [F.lit("Sem"), "semana_anio", F.lit(":"), "cancelados"], ["semana_anio", "mes"]
        ),
        "p1_v11_semaforo": Layout({"tipo": "semaforo", "cols": share_cols}, _row(*shares), by_share, joined=False),
        "p2_v1_temperatura": Layout(
            {"tipo": "scatter", "cols": "temp:retraso:vuelos"}, _row(_n("temp"), _n("retraso"), "vuelos"), ["fecha"]
        ),
        "p2_v2_humedad": Layout(
            {"tipo": "combo_barra_linea", "cols": "fecha:humedad:retraso"},
            _row("fecha_display", _n("humedad"), _n("retraso")),
            ["fecha"],
        ),
        "p2_v3_ciudades": Layout(
            {"tipo": "barra_h", "titulo": "Ranking Termométrico · °C"},
            _row("ciudad", _n("temp_avg")),
            ["temp_avg desc", "ciudad"],
        ),
        "p2_v4_adversas": Layout({"tipo": "donut"}, _row("grupo", _n("pct")), ["orden"]),
        "p2_v5_condicion": Layout(
            {"tipo": "barra_v", "titulo": "Retraso Prom por Condición Climática"},
            _row(F.coalesce("condicion_clima", F.lit("")), _n("avg_ret")),
            ["avg_ret desc", "condicion_clima"],
        ),
        "p2_v6_aerolinea_condicion": Layout(
            {"tipo": "heatmap_matriz", "cols": "aerolinea~condicion:avg_retraso"},
            _pair("airline_name", "condicion_clima", _n("avg_ret")),
            ["airline_name", "condicion_clima"],
            joined=False,
        ),
        "p2_v7_mezcla": Layout(
            {"tipo": "area_apilada100"},
            _pair("fecha_display", "condicion_predominante", _n("cnt", 0)),
            ["fecha", "condicion_predominante"],
            joined=False,
        ),
        "p2_v8_alertas": Layout(
            {"tipo": "mapa_densidad", "cols": "iata:dias_adversos:pct_retraso"},
            _row("airport_iata", "dias_adv", _n("pct_ret")),
            ["dias_adv desc", "airport_iata"],
        ),
        "p2_v9_variabilidad": Layout(
            {"tipo": "barra_h", "titulo": "Variabilidad Climática · Desv Est °C"},
            _row("ciudad", _n("std_temp")),
            ["std_temp desc", "ciudad"],
        ),
        "p2_v10_distribucion": Layout(
            {"tipo": "violin_barra", "cols": "condicion:avg_retraso:vuelos"},
            _row(F.coalesce("condicion_clima", F.lit("")), _n("avg_ret"), "vuelos"),
            ["avg_ret desc", "condicion_clima"],
        ),
        "p2_v11_correlacion": Layout(
            {"tipo": "heatmap_correlacion", "vars": "|".join(CORRELATED)}, _pair("var_x", "var_y", _n("r", 2)), ["orden"]
        ),
        "p3_v1_cierre": Layout(
            {"tipo": "donut_kpi", "kpi": None, "label": "Casos Completados", "meta": None},
            [F.lit("Completados:"), _n("pct_cerrado"), F.lit("|Pendientes:"), _n("pct_abierto")],
            ["meta"],
            numbers={"kpi": lambda: F.max(_n("pct_cerrado")), "meta": lambda: F.lit(str(CLOSURE_TARGET))},
        ),
        "p3_v2_motivos": Layout(
            {"tipo": "treemap", "cols": "motivo:total:pct"}, _row("motivo", "total", _n("pct")), ["total desc", "motivo"]
        ),
        "p3_v3_agentes": Layout(
            {"tipo": "barra_h", "titulo": "Carga Agentes · Casos Asignados"},
            _row("agente_id", "casos"),
            ["casos desc", "agente_id"],
            joined=False,
        ),
        "p3_v4_linea": Layout(
            {"tipo": "linea_acumulada", "cols": "fecha:cerrados:abiertos"},
            _row("fecha_display", F.coalesce(_n("cerrados", 0), F.lit("")), F.coalesce(_n("abiertos", 0), F.lit(""))),
            ["fecha"],
        ),
        "p3_v5_minutos": Layout(
            {"tipo": "barra_h", "titulo": "Motivos · Minutos de Retraso Asociado"},
            _row("motivo", fmt_thousands("min_ret")),
            ["min_ret desc", "motivo"],
        ),
        "p3_v6_reclamos": Layout(
            {"tipo": "combo_linea_linea", "cols": "fecha:vuelos_demorados:reclamos"},
            _row("fecha_display", "vuelos_dem", "reclamos"),
            ["fecha"],
        ),
        "p3_v7_tendencia": Layout(
            {"tipo": "linea_dual", "cols": "fecha:abiertos:cerrados"},
            _row("fecha_display", "abiertos", "cerrados"),
            ["fecha"],
        ),
        "p3_v8_efectividad": Layout(
            {"tipo": "barra_linea", "cols": "aerolinea:pct_resolucion:satisfaccion"},
            _row("airline_name", _n("pct_res"), _n("avg_sat", 2)),
            ["pct_res desc", "airline_name"],
            joined=False,
        ),
        "p3_v9_quejas": Layout(
            {"tipo": "funnel", "titulo": "Gravedad Motivos de Queja"}, _row("motivo", "total"), ["total desc", "motivo"]
        ),
        "p3_v10_detalle": Layout(
            {"tipo": "tabla", "cols": "id~fecha~aerolinea~motivo~estado~min_ret~satisfaccion~tiempo_res"},
            _row(
                "incidente_id", fmt_date("fecha", "dd/MM/yy"), "airline_name", "motivo", "estado",
                "minutos_retraso_asociado", _n("satisfaccion_cliente"), _n("tiempo_resolucion_horas"), sep="~",
            ),
            ["fecha desc", "incidente_id"],
            joined=False,
        ),
        "p3_v11_kpi": Layout({"tipo": "bullet_kpi"}, _row("kpi", _kpi_text(), _target_text()), ["orden"]),
    }


def visual_payload(name: str) -> Callable[..., DataFrame]:
    """Like ``visual(name)``, but the result is the text the dashboard component takes.

    One row with ``payload`` where the chart bounds the rows. Else one row per line, with the header entries as
    columns and the columns that order the lines; joining them is for the reader who knows how many there are.
    """
    layout = _layouts()[name]

    def run(facts, dims, where=None, **options) -> DataFrame:
        rows = visual(name)(facts, dims, where, **options)
        if not layout.joined:
            keys = [F.col(key.split()[0]) for key in layout.order]
            return rows.select(
                *[F.lit(v).alias(k) for k, v in layout.header.items()], join_text(*layout.pieces).alias("payload"), *keys
            )
        return as_json(
            joined_rows(rows, layout.pieces, layout.order, {k: make() for k, make in layout.numbers.items()}),
            layout.header,
            layout.numbers,
        )

    return run


def payload_names() -> list[str]:
    """The visuals of the dashboard; the running-total variant is an addition without a layout."""
    return [name for name in VISUALS if name != "p3_v4_acumulada"]
