"""Shared SQL: the raw view and the layers above it, as one CTE chain.

Written for the checking database, independently of the Spark code: duplicates
are ranked with window functions here, layers are plain subqueries.
"""

from __future__ import annotations

RAW = """
b AS (
 SELECT l_orderkey AS ok, l_partkey AS pk, l_orderkey*10 + l_linenumber AS transaction_id,
  CASE WHEN l_orderkey % 1013 = 5 THEN NULL ELSE o_custkey END AS customer_id,
  CASE WHEN l_orderkey % 1019 = 7 THEN -l_extendedprice ELSE l_extendedprice END AS amount,
  CASE WHEN l_orderkey % 983 = 3 THEN 'pix' WHEN o_orderpriority IN ('1-URGENT','5-LOW') THEN 'compra' WHEN o_orderpriority = '2-HIGH' THEN 'saque'
       WHEN o_orderpriority = '3-MEDIUM' THEN 'transferencia' ELSE 'pagamento' END AS transaction_type,
  CASE WHEN l_linenumber <= 3 THEN 'app' WHEN l_linenumber <= 5 THEN 'web' WHEN l_linenumber = 6 THEN 'pos' ELSE 'atm' END AS ch,
  CASE p_type WHEN 'STANDARD' THEN 'varejo' WHEN 'ECONOMY' THEN 'viagem' WHEN 'MEDIUM' THEN 'eletronico'
       WHEN 'SMALL' THEN 'alimentacao' WHEN 'LARGE' THEN 'servicos' ELSE 'saude' END AS cat,
  l_shipdate + to_hours(CAST(l_partkey % 24 AS INT)) AS ts, CAST(l_partkey % 24 AS INT) AS hr,
  CASE WHEN l_orderkey % 1021 = 11 THEN 250.0 ELSE l_quantity * 2.0 END AS risk_score,
  CASE WHEN c_mktsegment IN ('AUTOMOBILE','BUILDING') THEN 'Premium' WHEN c_mktsegment IN ('FURNITURE','HOUSEHOLD') THEN 'Standard' ELSE 'High-Risk' END AS seg,
  CASE WHEN l_orderkey % 1031 = 13 THEN 1000 ELSE CAST(300 + FLOOR((c_acctbal + 1000) * 6 / 110) AS INT) END AS credit_score,
  (l_orderkey*7919 + l_partkey*104729 + l_suppkey*1299709 + l_linenumber*15485863) % 1000 AS h, l_returnflag AS rf, l_linestatus AS ls
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey),
f AS (SELECT *, h < (CASE seg WHEN 'Premium' THEN 8 WHEN 'Standard' THEN 24 ELSE 90 END) * (CASE WHEN ch = 'app' THEN 2 ELSE 1 END)
       * (CASE WHEN cat = 'viagem' THEN 2 ELSE 1 END) + (CASE WHEN hr < 5 THEN 20 ELSE 0 END) AS fr FROM b),
r AS (SELECT transaction_id, customer_id, amount, transaction_type,
  CASE WHEN ok % 997 = 2 THEN 'whatsapp' WHEN pk % 50 = 1 THEN CONCAT(' ', UPPER(ch), ' ') ELSE ch END AS channel,
  CASE WHEN ok % 991 = 4 THEN 'jogos' WHEN pk % 40 = 3 THEN UPPER(cat) ELSE cat END AS merchant_category, ts,
  CASE WHEN ok % 977 = 6 THEN 'pending' WHEN fr OR (rf = 'R' AND ls = 'F') THEN 'declined' ELSE 'approved' END AS status,
  CAST(risk_score AS DOUBLE) AS risk_score, CASE WHEN ok % 971 = 8 THEN 'VIP' ELSE seg END AS segment, credit_score,
  CASE WHEN ok % 967 = 9 THEN 'talvez' WHEN pk % 30 = 0 THEN (CASE WHEN fr THEN '1' ELSE '0' END) ELSE (CASE WHEN fr THEN 'True' ELSE 'False' END) END AS is_fraud, ok
  FROM f),
raw_tx AS MATERIALIZED (
SELECT transaction_id, customer_id, amount, transaction_type, channel, merchant_category, ts AS "timestamp", status, risk_score, segment, credit_score, is_fraud FROM r
UNION ALL
SELECT transaction_id + 1000000000, customer_id, amount, transaction_type, channel, merchant_category, ts, status, risk_score, segment, credit_score, is_fraud FROM r WHERE ok % 500 = 3
UNION ALL
SELECT transaction_id, customer_id, amount, transaction_type, channel, merchant_category, NULL, status, risk_score, segment, credit_score, is_fraud FROM r WHERE ok % 500 = 13
UNION ALL
SELECT NULL, customer_id, amount, transaction_type, channel, merchant_category, ts, status, risk_score, segment, credit_score, is_fraud FROM r WHERE ok % 500 = 23)"""


def rnd(x: str, digits: int) -> str:
    """Half away from zero, on doubles."""
    s = f"1e{digits}"
    return f"(CASE WHEN ({x}) < 0 THEN -1 ELSE 1 END * FLOOR(ABS({x}) * {s} + 0.5e0) / {s})"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def div(a: str, b: str) -> str:
    return f"({dbl(a)} / NULLIF({dbl(b)}, 0))"


def pct(a: str, b: str, digits: int) -> str:
    return rnd(f"1e2 * {dbl(a)} / NULLIF({dbl(b)}, 0)", digits)


def cents(x: str) -> str:
    return (
        f"CAST(CASE WHEN ({x}) < 0 THEN -1 ELSE 1 END * FLOOR(ABS({x}) * 1e2 + 0.5e0) AS BIGINT)"
    )


def money(total_cents: str) -> str:
    return f"(CAST({total_cents} AS DOUBLE) / 1e2)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


MARKED = """
marked AS MATERIALIZED (SELECT *,
  ROW_NUMBER() OVER (PARTITION BY transaction_id ORDER BY "timestamp" NULLS LAST, customer_id NULLS LAST,
    amount NULLS LAST, transaction_type NULLS LAST, channel NULLS LAST, merchant_category NULLS LAST,
    status NULLS LAST, risk_score NULLS LAST, segment NULLS LAST, credit_score NULLS LAST,
    is_fraud NULLS LAST) > 1 AS repete_id,
  ROW_NUMBER() OVER (PARTITION BY customer_id, amount, transaction_type, channel, merchant_category,
    "timestamp", status, risk_score ORDER BY transaction_id NULLS LAST, segment NULLS LAST,
    credit_score NULLS LAST, is_fraud NULLS LAST) > 1 AS repete_conteudo
  FROM raw_tx)"""

STG = f"""
stg AS MATERIALIZED (SELECT transaction_id, customer_id, {rnd('amount', 2)} AS amount,
  LOWER(TRIM(transaction_type)) AS transaction_type, LOWER(TRIM(channel)) AS channel,
  LOWER(TRIM(merchant_category)) AS merchant_category, "timestamp" AS ts, LOWER(TRIM(status)) AS status,
  {rnd('risk_score', 2)} AS risk_score, TRIM(segment) AS segment, credit_score,
  CASE LOWER(TRIM(is_fraud)) WHEN 'true' THEN TRUE WHEN '1' THEN TRUE
       WHEN 'false' THEN FALSE WHEN '0' THEN FALSE END AS is_fraud, repete_id, repete_conteudo
  FROM marked)"""

# Rule names, domains and limits; the order is part of the reason text.
RULES = {
    "id_nulo": "transaction_id IS NULL OR customer_id IS NULL",
    "duplicata_id": "repete_id",
    "duplicata_conteudo": "repete_conteudo",
    "valor_invalido": "NOT COALESCE(amount > 0 AND amount <= 100000, FALSE)",
    "timestamp_invalido": "NOT COALESCE(ts >= TIMESTAMP '1995-01-01' AND ts < TIMESTAMP '2001-10-01', FALSE)",
    "tipo_fora_dominio": "COALESCE(transaction_type, '') NOT IN ('compra', 'saque', 'transferencia', 'pagamento')",
    "canal_fora_dominio": "COALESCE(channel, '') NOT IN ('app', 'web', 'pos', 'atm')",
    "categoria_fora_dominio": "COALESCE(merchant_category, '') NOT IN ('varejo', 'viagem', 'eletronico', 'alimentacao', 'servicos', 'saude')",
    "status_fora_dominio": "COALESCE(status, '') NOT IN ('approved', 'declined')",
    "segmento_fora_dominio": "COALESCE(segment, '') NOT IN ('Premium', 'Standard', 'High-Risk')",
    "risk_score_invalido": "NOT COALESCE(risk_score BETWEEN 0 AND 100, FALSE)",
    "credit_score_invalido": "NOT COALESCE(credit_score BETWEEN 300 AND 900, FALSE)",
    "cliente_fora_faixa": "customer_id < 1 OR customer_id > 10000000000000",
    "rotulo_invalido": "is_fraud IS NULL",
}

_REASON = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in RULES.items())

EVALUATED = f"""
evaluated AS MATERIALIZED (SELECT *, CONCAT_WS(';', {_REASON}) AS motivo FROM stg)"""

CLEAN = (
    "transaction_id, customer_id, amount, transaction_type, channel, merchant_category, ts, "
    "status, risk_score, segment, credit_score, is_fraud"
)

BRONZE = f"""
bronze AS MATERIALIZED (SELECT {CLEAN}, amount = 5 AS flag_valor_no_piso,
  credit_score = 300 OR credit_score = 900 AS flag_score_no_limite,
  is_fraud AND status = 'approved' AS flag_fraude_aprovada,
  CAST(YEAR(ts) AS INT) AS year, CAST(MONTH(ts) AS INT) AS month FROM evaluated WHERE motivo = '')"""

SILVER = f"""
silver AS MATERIALIZED (SELECT {CLEAN}, CAST(ts AS DATE) AS data, year, month,
  CAST(HOUR(ts) AS INT) AS hora, CAST(ISODOW(ts) AS INT) AS dia_semana_num,
  ['seg', 'ter', 'qua', 'qui', 'sex', 'sab', 'dom'][ISODOW(ts)] AS dia_semana,
  ['madrugada', 'manha', 'tarde', 'noite'][1 + HOUR(ts) // 6] AS periodo_dia,
  CASE WHEN credit_score >= 700 THEN '3_alto (700-900)' WHEN credit_score >= 500 THEN '2_medio (500-699)'
       ELSE '1_baixo (300-499)' END AS faixa_credit_score,
  CASE WHEN risk_score >= 80 THEN '3_alto (>=80)' WHEN risk_score >= 60 THEN '2_medio (60-79)'
       ELSE '1_baixo (<60)' END AS faixa_risk_score,
  status = 'declined' AS recusada FROM bronze)"""

MEASURES = f"""COUNT(*) AS transacoes, COUNT(*) FILTER (WHERE is_fraud) AS fraudes,
  COUNT(*) FILTER (WHERE recusada) AS recusadas,
  COUNT(*) FILTER (WHERE recusada AND NOT is_fraud) AS recusas_legitimas,
  {money(f"SUM({cents('amount')})")} AS valor_total,
  {money(f"COALESCE(SUM({cents('amount')}) FILTER (WHERE is_fraud), 0)")} AS valor_fraude"""

CUBE_KEYS = "year, month, channel, merchant_category, segment, periodo_dia"
DAILY_KEYS = "data, channel"
HOURLY_KEYS = "hora, dia_semana_num, dia_semana"
SCORE_KEYS = "segment, faixa_credit_score, faixa_risk_score"

GOLD = f"""
gold_cubo_risco AS MATERIALIZED (SELECT {CUBE_KEYS}, {MEASURES} FROM silver GROUP BY {CUBE_KEYS}),
gold_serie_diaria AS MATERIALIZED (SELECT {DAILY_KEYS}, {MEASURES} FROM silver GROUP BY {DAILY_KEYS}),
gold_perfil_horario AS MATERIALIZED (SELECT {HOURLY_KEYS}, {MEASURES} FROM silver GROUP BY {HOURLY_KEYS}),
gold_segmento_score AS MATERIALIZED (SELECT {SCORE_KEYS}, {MEASURES}, {dbl('SUM(credit_score)')} AS soma_credit_score
  FROM silver GROUP BY {SCORE_KEYS})"""

_CHAIN = [RAW, MARKED, STG, EVALUATED, BRONZE, SILVER, GOLD]


def over(level: str, body: str, *ctes: str) -> str:
    """A query over the chain up to ``level``, with further CTEs before the body."""
    depth = {"raw": 1, "marked": 2, "stg": 3, "evaluated": 4, "bronze": 5, "silver": 6, "gold": 7}
    chain = [*_CHAIN[: depth[level]], *ctes]
    return "WITH " + ",\n".join(c.strip() for c in chain) + "\n" + body
