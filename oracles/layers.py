"""Oracles for sources, cleaning, quality rules, layers and loads."""

from __future__ import annotations

from oracles.base import (
    CLEAN,
    CUBE_KEYS,
    DAILY_KEYS,
    HOURLY_KEYS,
    MEASURES,
    RULES,
    SCORE_KEYS,
    big,
    cents,
    money,
    over,
)

RAW_COLUMNS = (
    'transaction_id, customer_id, amount, transaction_type, channel, merchant_category, "timestamp", '
    "status, risk_score, segment, credit_score, is_fraud"
)

SILVER_COLUMNS = [
    ("transaction_id", "bigint"),
    ("customer_id", "bigint"),
    ("amount", "double"),
    ("transaction_type", "string"),
    ("channel", "string"),
    ("merchant_category", "string"),
    ("ts", "timestamp_ntz"),
    ("status", "string"),
    ("risk_score", "double"),
    ("segment", "string"),
    ("credit_score", "int"),
    ("is_fraud", "boolean"),
    ("data", "date"),
    ("hora", "int"),
    ("dia_semana_num", "int"),
    ("dia_semana", "string"),
    ("periodo_dia", "string"),
    ("faixa_credit_score", "string"),
    ("faixa_risk_score", "string"),
    ("recusada", "boolean"),
    # partition columns come last when a layer is read back
    ("year", "int"),
    ("month", "int"),
]

_SCHEMA = " UNION ALL ".join(
    f"SELECT {i} AS posicao, '{name}' AS coluna, '{kind}' AS tipo, COUNT({name}) AS preenchidas FROM silver"
    for i, (name, kind) in enumerate(SILVER_COLUMNS, start=1)
)

_HITS = " UNION ALL ".join(
    f"SELECT {i} AS ordem, '{name}' AS regra, COUNT(*) AS linhas FROM stg WHERE {cond}"
    for i, (name, cond) in enumerate(RULES.items(), start=1)
)

_FUNNEL = " UNION ALL ".join(
    f"SELECT {i} AS ordem, '{name}' AS camada, COUNT(*) AS linhas FROM {source}"
    for i, (name, source) in enumerate(
        [
            ("raw_particionada", "raw_tx"),
            ("bronze", "bronze"),
            ("quarentena", "(SELECT 1 FROM evaluated WHERE motivo <> '')"),
            ("silver", "silver"),
            ("gold_cubo_risco", "gold_cubo_risco"),
            ("gold_serie_diaria", "gold_serie_diaria"),
            ("gold_perfil_horario", "gold_perfil_horario"),
            ("gold_segmento_score", "gold_segmento_score"),
        ],
        start=1,
    )
)

_MARTS = ("gold_cubo_risco", "gold_serie_diaria", "gold_perfil_horario", "gold_segmento_score")
_CONSERVED = " UNION ALL ".join(
    f"SELECT '{m}' AS mart, COUNT(*) AS linhas, {big('SUM(transacoes)')} AS transacoes, "
    f"SUM(transacoes) = (SELECT COUNT(*) FROM silver) AS confere FROM {m}"
    for m in _MARTS
)

_YM = 'CAST(YEAR("timestamp") AS INT) AS year, CAST(MONTH("timestamp") AS INT) AS month'

_BY_MONTH = f"""SELECT year, month, COUNT(*) AS transacoes, COUNT(*) FILTER (WHERE {{fraud}}) AS fraudes,
  {money(f"SUM({cents('amount')})")} AS valor_total FROM silver GROUP BY year, month"""

_CUSTOMERS = """clientes AS (SELECT c_custkey AS customer_id, c_nationkey AS nacao, c_mktsegment AS mercado
  FROM customer),
fatos AS (SELECT transaction_id, is_fraud, CASE WHEN customer_id % 17 = 0 THEN -customer_id ELSE customer_id END AS customer_id
  FROM silver)"""

# Late labels of a year, one refusal in the web revoked again, frauds at points of sale cleared.
_RELABELLED = """rotulada AS MATERIALIZED (SELECT * REPLACE (CASE WHEN year = 2001 AND is_fraud AND channel = 'pos' THEN FALSE
  WHEN year = 2001 AND recusada AND risk_score >= 80 AND channel <> 'web' THEN TRUE ELSE is_fraud END AS is_fraud) FROM silver)"""

_RELABELLED_TOTALS = " UNION ALL ".join(
    f"""SELECT '{name}' AS mart, (SELECT COUNT(*) FROM (SELECT DISTINCT {keys} FROM rotulada)) AS linhas, COUNT(*) AS transacoes,
      COUNT(*) FILTER (WHERE is_fraud) AS fraudes, COUNT(*) FILTER (WHERE recusada AND NOT is_fraud) AS recusas_legitimas,
      {big(f"SUM({cents('amount')}) FILTER (WHERE is_fraud)")} AS centavos_fraude FROM rotulada"""
    for name, keys in zip(_MARTS, (CUBE_KEYS, DAILY_KEYS, HOURLY_KEYS, SCORE_KEYS))
)

# Planted faults and their outcomes.
_FAULTS = """(VALUES (0, 'copia_exata', 'duplicata_id;duplicata_conteudo'),
  (1, 'conteudo_com_outro_id', 'duplicata_conteudo'), (2, 'valor_negativo', 'valor_invalido'),
  (3, 'valor_zero', 'valor_invalido'), (4, 'risk_score_150', 'risk_score_invalido'),
  (5, 'credit_score_1000', 'credit_score_invalido'), (6, 'fora_do_periodo', 'timestamp_invalido'),
  (7, 'canal_whatsapp', 'canal_fora_dominio'), (8, 'rotulo_talvez', 'rotulo_invalido'),
  (9, 'cliente_zero', 'cliente_fora_faixa'), (10, 'caixa_e_espacos', 'aceita app/viagem'),
  (11, 'valor_texto', 'ausente')) t(k, falha, esperado)"""

LAYER_ORACLES = {
    "raw_scan": over("raw", f"SELECT {RAW_COLUMNS} FROM raw_tx"),
    "raw_rejects": over(
        "raw",
        """SELECT transaction_id, 'amount' AS coluna, 'abc' AS valor FROM raw_tx WHERE transaction_id % 701 = 0
           UNION ALL
           SELECT transaction_id, 'credit_score', 'n/d' FROM raw_tx WHERE transaction_id % 503 = 0""",
    ),
    "raw_multiline": over(
        "raw",
        """SELECT transaction_id, CASE WHEN transaction_id % 97 = 0 THEN CONCAT('a,"b"', CHR(10), ',"c,', CHR(10), segment)
             ELSE segment END AS segment, credit_score, is_fraud FROM raw_tx""",
    ),
    "raw_multiline_rejects": over(
        "raw",
        """SELECT transaction_id, 'credit_score' AS coluna, 'n/d' AS valor FROM raw_tx
           WHERE transaction_id % 701 = 0""",
    ),
    "landing_reconcile": over(
        "raw",
        "SELECT COUNT(*) AS linhas_origem, COUNT(*) AS linhas_destino, TRUE AS integro FROM raw_tx",
    ),
    "partition_counts": over(
        "raw", f"SELECT {_YM}, COUNT(*) AS linhas FROM raw_tx GROUP BY ALL"
    ),
    "pruned_month": over(
        "raw",
        f"""SELECT {_YM}, COUNT(*) AS linhas FROM raw_tx
            WHERE "timestamp" >= TIMESTAMP '1998-03-01' AND "timestamp" < TIMESTAMP '1998-04-01' GROUP BY ALL""",
    ),
    "pruning_evidence": over(
        "raw",
        """SELECT COUNT(*) AS linhas, CAST(0 AS BIGINT) AS arquivos_de_outros_meses, TRUE AS leu_menos_arquivos FROM raw_tx
           WHERE "timestamp" >= TIMESTAMP '1998-03-01' AND "timestamp" < TIMESTAMP '1998-04-01'""",
    ),
    "schema_report": over("silver", _SCHEMA),
    "row_funnel": over("gold", _FUNNEL),
    "incremental_load": over(
        "raw",
        f"""SELECT {_YM}, COUNT(*) FILTER (WHERE COALESCE(early, FALSE)) AS linhas_iniciais,
              COUNT(*) FILTER (WHERE NOT COALESCE(early, FALSE)) AS linhas_incrementais
            FROM (SELECT *, "timestamp" < TIMESTAMP '2000-01-01' AND NOT COALESCE("timestamp" = (
                SELECT MAX("timestamp") FROM raw_tx WHERE "timestamp" < TIMESTAMP '2000-01-01')
                AND transaction_id % 2 = 0, FALSE) AS early FROM raw_tx) GROUP BY ALL""",
    ),
    "reprocess_month": over("silver", _BY_MONTH.format(fraud="is_fraud")),
    "late_labels": over(
        "silver",
        _BY_MONTH.format(
            fraud="is_fraud OR (year = 2001 AND recusada AND risk_score >= 80 AND channel <> 'web')"
        ),
    ),
    "gold_after_labels": over("silver", f"SELECT {CUBE_KEYS}, {MEASURES} FROM rotulada GROUP BY {CUBE_KEYS}", _RELABELLED),
    "gold_after_labels_totals": over("silver", _RELABELLED_TOTALS, _RELABELLED),
    "stg_clean": over("stg", "SELECT * FROM stg"),
    "label_values": over("raw", "SELECT is_fraud, COUNT(*) AS linhas FROM raw_tx GROUP BY 1"),
    "label_parse": over(
        "stg",
        """SELECT m.is_fraud AS texto, CASE WHEN m.is_fraud IN ('True', '1') THEN TRUE
             WHEN m.is_fraud IN ('False', '0') THEN FALSE END AS rotulo, COUNT(*) AS linhas
           FROM raw_tx m GROUP BY 1, 2""",
    ),
    "dedup_id": over("marked", f"SELECT {RAW_COLUMNS} FROM marked WHERE NOT repete_id"),
    "dedup_content": over("marked", f"SELECT {RAW_COLUMNS} FROM marked WHERE NOT repete_conteudo"),
    "rule_hits": over("stg", _HITS),
    "rule_matrix": over(
        "bronze",
        f"""SELECT falha, esperado, COUNT(*) AS linhas, COUNT(*) AS conformes
            FROM bronze JOIN {_FAULTS} ON transaction_id % 12 = k GROUP BY falha, esperado""",
    ),
    "bronze": over("bronze", "SELECT * FROM bronze"),
    "quarantine": over("evaluated", f"SELECT {CLEAN}, motivo FROM evaluated WHERE motivo <> ''"),
    "bronze_flags": over(
        "bronze",
        """SELECT COUNT(*) FILTER (WHERE flag_valor_no_piso) AS valor_no_piso,
             COUNT(*) FILTER (WHERE flag_score_no_limite) AS credit_score_no_limite,
             COUNT(*) FILTER (WHERE flag_fraude_aprovada) AS fraude_com_status_aprovado FROM bronze""",
    ),
    "label_x_status": over(
        "bronze", "SELECT is_fraud, status, COUNT(*) AS linhas FROM bronze GROUP BY ALL"
    ),
    "segment_consistency": over(
        "bronze",
        """SELECT COUNT(*) AS entidades, COUNT(*) FILTER (WHERE n > 1) AS entidades_inconsistentes
           FROM (SELECT customer_id, COUNT(DISTINCT segment) AS n FROM bronze GROUP BY 1)""",
    ),
    "segment_consistency_by_channel": over(
        "bronze",
        """SELECT COUNT(*) AS entidades, COUNT(*) FILTER (WHERE n > 1) AS entidades_inconsistentes
           FROM (SELECT customer_id, channel, COUNT(DISTINCT segment) AS n FROM bronze GROUP BY 1, 2)""",
    ),
    "ts_granularity": over(
        "bronze",
        """SELECT COUNT(DISTINCT MINUTE(ts)) AS minutos_distintos,
             COUNT(DISTINCT SECOND(ts)) AS segundos_distintos FROM bronze""",
    ),
    "silver": over("silver", "SELECT * FROM silver"),
    **{m: over("gold", f"SELECT * FROM {m}") for m in _MARTS},
    "gold_conservation": over("gold", _CONSERVED),
    "panel_json": over(
        "gold",
        f"""SELECT {CUBE_KEYS}, transacoes, fraudes, recusadas, recusas_legitimas, valor_total, valor_fraude
            FROM gold_cubo_risco""",
    ),
    "sql_view": over(
        "gold",
        f"""SELECT channel, {big('SUM(transacoes)')} AS transacoes, {big('SUM(fraudes)')} AS fraudes
            FROM gold_serie_diaria GROUP BY 1""",
    ),
    "enrich_customer": over(
        "silver",
        """SELECT transaction_id, s.customer_id, is_fraud, nacao, mercado
           FROM fatos s LEFT JOIN clientes c ON s.customer_id = c.customer_id""",
        _CUSTOMERS,
    ),
    "orphans": over(
        "silver",
        """SELECT customer_id, COUNT(*) AS transacoes FROM fatos
           WHERE customer_id NOT IN (SELECT customer_id FROM clientes) GROUP BY 1""",
        _CUSTOMERS,
    ),
}
