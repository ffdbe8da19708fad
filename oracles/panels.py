"""Oracles for the dashboard panels."""

from __future__ import annotations

from oracles.base import CUBE_KEYS, big, cents, div, money, over, pct, rnd

_OVERALL = f"(SELECT {div('SUM(fraudes)', 'SUM(transacoes)')} FROM gold_cubo_risco)"
_OVERALL_PCT = rnd(f"1e2 * {_OVERALL}", 4)
_VF = money(f"SUM({cents('valor_fraude')})")
_MEASURES = "transacoes, fraudes, recusadas, recusas_legitimas, valor_total, valor_fraude"

APP = "channel = 'app'"
APP_TRAVEL = "channel = 'app' AND merchant_category = 'viagem'"
HIGH_NIGHT = "segment = 'High-Risk' AND periodo_dia = 'madrugada'"


def side(rate: str) -> str:
    """Five percent either side of the overall rate is neutral."""
    return (
        f"CASE WHEN {rate} > {_OVERALL} * 1.05e0 THEN 'acima' "
        f"WHEN {rate} < {_OVERALL} * 0.95e0 THEN 'abaixo' ELSE 'neutra' END"
    )


def kpis(where: str) -> str:
    return over(
        "gold",
        f"""SELECT n AS transacoes, {pct('n', 'tn', 4)} AS pct_volume_total, {money('v')} AS valor_total,
              f AS fraudes, {pct('f', 'n', 4)} AS taxa_pct, {pct('tf', 'tn', 4)} AS taxa_geral_pct,
              {rnd(f"{div('f', 'n')} / {div('tf', 'tn')}", 4)} AS razao_geral,
              {side(f"COALESCE({div('f', 'n')}, 0e0)")} AS classe, {money('vf')} AS valor_fraude,
              {pct('vf', 'v', 4)} AS pct_valor, {rnd(div(money('vf'), 'f'), 4)} AS ticket_fraude,
              r AS recusadas, rl AS recusas_legitimas, {pct('rl', 'r', 4)} AS pct_recusas,
              {pct('rl', 'n - f', 4)} AS pct_legitimas FROM s, t""",
        f"""s AS (SELECT {big('COALESCE(SUM(transacoes), 0)')} n, {big('COALESCE(SUM(fraudes), 0)')} f,
              {big('COALESCE(SUM(recusadas), 0)')} r, {big('COALESCE(SUM(recusas_legitimas), 0)')} rl,
              {big(f"COALESCE(SUM({cents('valor_total')}), 0)")} v,
              {big(f"COALESCE(SUM({cents('valor_fraude')}), 0)")} vf FROM gold_cubo_risco WHERE {where})""",
        "t AS (SELECT SUM(transacoes) tn, SUM(fraudes) tf FROM gold_cubo_risco)",
    )


def monthly(where: str) -> str:
    return over(
        "gold",
        f"""SELECT month, {big('SUM(transacoes)')} AS transacoes, {big('SUM(fraudes)')} AS fraudes,
              {pct('SUM(fraudes)', 'SUM(transacoes)', 4)} AS taxa_pct, {_OVERALL_PCT} AS taxa_geral_pct
            FROM gold_cubo_risco WHERE {where} GROUP BY 1""",
    )


def rolling(keys: str, where: str, day_text: bool) -> str:
    part = f"PARTITION BY {keys}" if keys else ""
    select = f"{keys}, " if keys else ""
    text = ", STRFTIME(data, '%Y-%m-%d') AS dia" if day_text else ""
    return over(
        "gold",
        f"""SELECT {select}data, n AS transacoes, f AS fraudes,
              CASE WHEN ROW_NUMBER() OVER ({part} ORDER BY data) > 6 THEN
                {pct('SUM(f) OVER w', 'SUM(n) OVER w', 4)} END AS taxa_movel_pct{text}
            FROM d WINDOW w AS ({part} ORDER BY data ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
        f"""d AS (SELECT {select}data, {big('SUM(transacoes)')} n, {big('SUM(fraudes)')} f
              FROM gold_serie_diaria WHERE {where} GROUP BY ALL)""",
    )


def bars(dim: str, where: str) -> str:
    return over(
        "gold",
        f"""SELECT {dim}, n AS transacoes, f AS fraudes, {pct('f', 'n', 4)} AS taxa_pct,
              {side(div('f', 'n'))} AS classe, {pct('n', 'SUM(n) OVER ()', 4)} AS pct_volume,
              {pct('f', 'SUM(f) OVER ()', 4)} AS pct_fraudes, {money('vf')} AS valor_fraude FROM g""",
        f"""g AS (SELECT {dim}, {big('SUM(transacoes)')} n, {big('SUM(fraudes)')} f,
              {big(f"SUM({cents('valor_fraude')})")} vf FROM gold_cubo_risco WHERE {where} GROUP BY 1)""",
    )


def heat_channel_category(where: str) -> str:
    return over(
        "gold",
        f"""SELECT c.channel, k.merchant_category, COALESCE(n, 0) AS transacoes, COALESCE(f, 0) AS fraudes,
              {pct('f', 'n', 4)} AS taxa_pct
            FROM (SELECT UNNEST(['app', 'web', 'pos', 'atm']) AS channel) c
            CROSS JOIN (SELECT UNNEST(['varejo', 'viagem', 'eletronico', 'alimentacao', 'servicos', 'saude'])
                        AS merchant_category) k
            LEFT JOIN g ON g.channel = c.channel AND g.merchant_category = k.merchant_category""",
        f"""g AS (SELECT channel, merchant_category, {big('SUM(transacoes)')} n, {big('SUM(fraudes)')} f
              FROM gold_cubo_risco WHERE {where} GROUP BY 1, 2)""",
    )


_HEAT_HOUR = over(
    "gold",
    f"""SELECT CAST(d AS INT) AS dia_semana_num, CAST(h AS INT) AS hora, COALESCE(transacoes, 0) AS transacoes,
          COALESCE(fraudes, 0) AS fraudes, {pct('fraudes', 'transacoes', 4)} AS taxa_pct,
          {rnd('1e2 * taxa', 4)} AS taxa_hora_pct, {side('taxa')} AS classe_hora
        FROM RANGE(1, 8) x(d) CROSS JOIN RANGE(0, 24) y(h)
        LEFT JOIN gold_perfil_horario ON dia_semana_num = d AND hora = h
        LEFT JOIN hours ON hh = h""",
    f"""hours AS (SELECT hora AS hh, {div('SUM(fraudes)', 'SUM(transacoes)')} AS taxa
          FROM gold_perfil_horario GROUP BY 1)""",
)


def merged(where: str, min_n: int) -> list[str]:
    """Level by level: emit what reaches the minimum, pass the rest on."""
    levels = [
        (4, ["channel", "merchant_category", "segment", "periodo_dia"]),
        (3, ["channel", "merchant_category", "segment"]),
        (2, ["channel", "segment"]),
        (1, ["segment"]),
    ]
    dims = levels[0][1]
    ctes = [f"p4 AS (SELECT * FROM gold_cubo_risco WHERE {where})"]
    outs = []
    agg = f"{big('SUM(transacoes)')} AS transacoes, {big('SUM(fraudes)')} AS fraudes, {_VF} AS valor_fraude"
    for level, keys in levels:
        shown = ", ".join(d if d in keys else f"CAST(NULL AS VARCHAR) AS {d}" for d in dims)
        by = ", ".join(keys)
        ctes.append(
            f"""e{level} AS (SELECT {level} AS nivel, {shown}, {agg} FROM p{level} GROUP BY {by}
                HAVING SUM(transacoes) >= {min_n})"""
        )
        match = " AND ".join(f"p.{k} = e.{k}" for k in keys)
        ctes.append(
            f"p{level - 1} AS (SELECT p.* FROM p{level} p WHERE NOT EXISTS "
            f"(SELECT 1 FROM e{level} e WHERE {match}))"
        )
        outs.append(f"SELECT * FROM e{level}")
    nulls = ", ".join(f"CAST(NULL AS VARCHAR) AS {d}" for d in dims)
    outs.append(f"SELECT 0 AS nivel, {nulls}, {agg} FROM p0 HAVING COUNT(*) > 0")
    ctes.append("grupos AS (" + " UNION ALL ".join(outs) + ")")
    order = (
        f"nivel = 0, {div('fraudes', 'transacoes')} DESC, transacoes DESC, nivel DESC, "
        "channel NULLS FIRST, merchant_category NULLS FIRST, segment NULLS FIRST, periodo_dia NULLS FIRST"
    )
    ctes.append(
        f"""curva AS (SELECT *, ROW_NUMBER() OVER (ORDER BY {order}) AS posicao,
              {big(f"SUM(transacoes) OVER (ORDER BY {order} ROWS UNBOUNDED PRECEDING)")} AS an,
              {big(f"SUM(fraudes) OVER (ORDER BY {order} ROWS UNBOUNDED PRECEDING)")} AS af,
              {big('SUM(transacoes) OVER ()')} AS tn, {big('SUM(fraudes) OVER ()')} AS tf FROM grupos)"""
    )
    return ctes


def small_cells(where: str, min_n: int) -> str:
    return over(
        "gold",
        f"SELECT *, {pct('fraudes', 'transacoes', 4)} AS taxa_pct FROM grupos",
        *merged(where, min_n),
    )


_CELL = "channel, merchant_category, segment, periodo_dia"


def curve(where: str, min_n: int) -> str:
    return over(
        "gold",
        f"""SELECT CAST(posicao AS INT) AS posicao, nivel, {_CELL}, transacoes, fraudes, an AS transacoes_acum,
              af AS fraudes_acum, {pct('an', 'tn', 4)} AS pct_volume_acum,
              COALESCE({pct('af', 'tf', 4)}, 0e0) AS pct_fraudes_acum FROM curva""",
        *merged(where, min_n),
    )


_IN_CUT = "1e2 * CAST(an - transacoes AS DOUBLE) / CAST(tn AS DOUBLE) < {cut}"


def cutoff(where: str, min_n: int, cut: str) -> str:
    return over(
        "gold",
        f"""SELECT CAST({cut} AS DOUBLE) AS corte_pct, COUNT(*) AS grupos, {big('SUM(transacoes)')} AS transacoes,
              {pct('SUM(transacoes)', 'MAX(tn)', 4)} AS pct_volume, {big('SUM(fraudes)')} AS fraudes,
              {pct('SUM(fraudes)', 'MAX(tf)', 4)} AS pct_fraudes,
              {pct('SUM(fraudes)', 'SUM(transacoes)', 4)} AS taxa_pct,
              {big('SUM(transacoes) - SUM(fraudes)')} AS legitimas_incomodadas
            FROM curva WHERE {_IN_CUT.format(cut=cut)}""",
        *merged(where, min_n),
    )


def table(where: str, min_n: int, cut: str) -> str:
    return over(
        "gold",
        f"""SELECT CAST(posicao AS INT) AS posicao, nivel, {_CELL},
              {rnd(f"{div('fraudes', 'transacoes')} / {_OVERALL}", 4)} AS razao_geral, transacoes, fraudes,
              {pct('fraudes', 'transacoes', 4)} AS taxa_pct, valor_fraude,
              {pct('an', 'tn', 4)} AS pct_volume_acum, COALESCE({pct('af', 'tf', 4)}, 0e0) AS pct_fraudes_acum,
              {_IN_CUT.format(cut=cut)} AS no_corte FROM curva""",
        *merged(where, min_n),
    )


_ENGINE = over(
    "gold",
    f"""SELECT {big('SUM(transacoes)')} AS transacoes, {big('SUM(fraudes)')} AS fraudes,
          {pct('SUM(transacoes)', '(SELECT SUM(transacoes) FROM gold_cubo_risco)', 4)} AS pct_volume,
          {pct('SUM(fraudes)', '(SELECT SUM(fraudes) FROM gold_cubo_risco)', 4)} AS pct_fraudes
        FROM gold_segmento_score WHERE faixa_risk_score LIKE '3_%'""",
)

_SLICE_DIMS = "month, channel, merchant_category, segment, periodo_dia"
_ALL_SLICES = over(
    "gold",
    f"""SELECT {_SLICE_DIMS}, {big('SUM(transacoes)')} AS transacoes, {big('SUM(fraudes)')} AS fraudes,
          {big('SUM(recusadas)')} AS recusadas, {big('SUM(recusas_legitimas)')} AS recusas_legitimas,
          {money(f"SUM({cents('valor_total')})")} AS valor_total, {_VF} AS valor_fraude,
          {big(f'GROUPING({_SLICE_DIMS})')} AS nivel
        FROM gold_cubo_risco GROUP BY CUBE ({_SLICE_DIMS})""",
)

PANEL_ORACLES = {
    "panel_cube": over(
        "gold",
        f"SELECT {CUBE_KEYS}, {_MEASURES} FROM gold_cubo_risco",
    ),
    "panel_kpis": kpis("TRUE"),
    "panel_kpis_app_viagem": kpis(APP_TRAVEL),
    "panel_kpis_vazio": kpis("month = 13"),
    "panel_monthly": monthly("TRUE"),
    "panel_monthly_app": monthly(APP),
    "rolling7_rate": rolling("", "TRUE", True),
    "rolling7_rate_app": rolling("", APP, True),
    "rolling7_by_channel": rolling("channel", "TRUE", False),
    "panel_bars_channel": bars("channel", "TRUE"),
    "panel_bars_channel_app_viagem": bars("channel", "merchant_category = 'viagem'"),
    "panel_bars_category": bars("merchant_category", APP),
    "panel_bars_segment": bars("segment", "month = 3"),
    "panel_heat_channel_category": heat_channel_category("TRUE"),
    "panel_heat_channel_category_night": heat_channel_category(f"{HIGH_NIGHT} AND month = 3"),
    "panel_heat_hour_dow": _HEAT_HOUR,
    "panel_smallcell_rollup": small_cells("TRUE", 50),
    "panel_smallcell_rollup_100": small_cells("TRUE", 100),
    "panel_smallcell_rollup_200": small_cells("TRUE", 200),
    "panel_smallcell_rollup_app": small_cells(APP, 100),
    "capture_curve": curve("TRUE", 100),
    "capture_curve_madrugada": curve(HIGH_NIGHT, 30),
    "panel_cutoff": cutoff("TRUE", 50, "20e0"),
    "panel_cutoff_5_app": cutoff(APP, 30, "5e0"),
    "panel_table": table("TRUE", 50, "20e0"),
    "panel_table_app": table(APP, 100, "10e0"),
    "engine_point": _ENGINE,
    "risk_cube_all": _ALL_SLICES,
}
