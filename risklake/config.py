"""Fixed values and rule parameters.

Everything here is data: names, domains, limits and labels that results must
carry. Limits that depend on the data set (dates, amount ceiling, customer
range) are parameters of :class:`RuleBounds`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Raw file columns, in file order.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
        T.StructField("risk_score", T.DoubleType()),
        T.StructField("segment", T.StringType()),
        T.StructField("credit_score", T.IntegerType()),
        T.StructField("is_fraud", T.StringType()),
    ]
)

CLEAN_COLUMNS = (
    "transaction_id",
    "customer_id",
    "amount",
    "transaction_type",
    "channel",
    "merchant_category",
    "ts",
    "status",
    "risk_score",
    "segment",
    "credit_score",
    "is_fraud",
)

# A content duplicate repeats all of these source columns under another id.
CONTENT_KEY = (
    "customer_id",
    "amount",
    "transaction_type",
    "channel",
    "merchant_category",
    "timestamp",
    "status",
    "risk_score",
)

TRANSACTION_TYPES = ("compra", "saque", "transferencia", "pagamento")
CHANNELS = ("app", "web", "pos", "atm")
CATEGORIES = ("varejo", "viagem", "eletronico", "alimentacao", "servicos", "saude")
STATUSES = ("approved", "declined")
SEGMENTS = ("Premium", "Standard", "High-Risk")
LABEL_TRUE = ("true", "1")
LABEL_FALSE = ("false", "0")

WEEKDAYS = ("seg", "ter", "qua", "qui", "sex", "sab", "dom")  # Monday first
PERIODS = ((6, "madrugada"), (12, "manha"), (18, "tarde"), (None, "noite"))
CREDIT_BANDS = (
    (500, "1_baixo (300-499)"),
    (700, "2_medio (500-699)"),
    (None, "3_alto (700-900)"),
)
RISK_BANDS = ((60, "1_baixo (<60)"), (80, "2_medio (60-79)"), (None, "3_alto (>=80)"))

MARTS = {
    "gold_cubo_risco": (
        "year",
        "month",
        "channel",
        "merchant_category",
        "segment",
        "periodo_dia",
    ),
    "gold_serie_diaria": ("data", "channel"),
    "gold_perfil_horario": ("hora", "dia_semana_num", "dia_semana"),
    "gold_segmento_score": ("segment", "faixa_credit_score", "faixa_risk_score"),
}

# Labels of the simulated extra-authentication rules.
SIMULATED_RULES = {
    "R1": "R1 · risk_score >= 80 (motor atual)",
    "R2": "R2 · app + viagem",
    "R3": "R3 · High-Risk no app",
    "R4": "R4 · todo High-Risk",
    "R5": "R5 · High-Risk OU app+viagem",
    "R6": "R6 · High-Risk OU app+viagem OU app na madrugada",
}

# Model inputs: indicator name -> (column, level); the levels left out
# (Premium, pos, varejo, compra, other periods) are the reference levels.
INDICATORS = {
    "seg_high_risk": ("segment", "High-Risk"),
    "seg_standard": ("segment", "Standard"),
    "canal_app": ("channel", "app"),
    "canal_web": ("channel", "web"),
    "canal_atm": ("channel", "atm"),
    "cat_viagem": ("merchant_category", "viagem"),
    "cat_saude": ("merchant_category", "saude"),
    "cat_alimentacao": ("merchant_category", "alimentacao"),
    "cat_servicos": ("merchant_category", "servicos"),
    "cat_eletronico": ("merchant_category", "eletronico"),
    "tipo_saque": ("transaction_type", "saque"),
    "tipo_transferencia": ("transaction_type", "transferencia"),
    "tipo_pagamento": ("transaction_type", "pagamento"),
    "madrugada": ("periodo_dia", "madrugada"),
}
NUMERIC_FEATURES = ("risk_score_10pts", "credit_score_100pts", "log_valor")
# --- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class RuleBounds:
    """Limits the quality rules compare against."""

    amount_max: float = 40000.0
    ts_from: str = "2025-01-01 00:00:00"
    ts_until: str = "2026-01-01 00:00:00"
    risk_min: float = 0.0
    risk_max: float = 100.0
    credit_min: int = 300
    credit_max: int = 900
    customer_min: int = 1
    customer_max: int = 8000


# The given TPC-H-like tables span 1995-2001 and number their customers with
# the scale factor, so the customer ceiling is set beyond any scale.
GIVEN_TABLES_BOUNDS = RuleBounds(
    amount_max=100000.0,
    ts_from="1995-01-01 00:00:00",
    ts_until="2001-10-01 00:00:00",
    customer_max=10_000_000_000_000,
)
