"""Cleaning, quality rules, and the valid / quarantine split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from risklake import config
from risklake.config import CLEAN_COLUMNS, RuleBounds
from risklake.functions.numeric import round_half
from risklake.functions.text import folded, label

DUPLICATE_FLAGS = ("repete_id", "repete_conteudo")


def stage(raw: DataFrame) -> DataFrame:
    """Cleaned columns; other columns (partitions, duplicate flags) pass through.

    A frame without duplicate flags (a stream, say) is staged as all-unique.
    """
    cleaned = {
        "transaction_id": F.col("transaction_id"),
        "customer_id": F.col("customer_id"),
        "amount": round_half(F.col("amount"), 2),
        "transaction_type": folded(F.col("transaction_type")),
        "channel": folded(F.col("channel")),
        "merchant_category": folded(F.col("merchant_category")),
        "ts": F.col("timestamp"),
        "status": folded(F.col("status")),
        "risk_score": round_half(F.col("risk_score"), 2),
        "segment": F.trim("segment"),
        "credit_score": F.col("credit_score"),
        "is_fraud": label(F.col("is_fraud")),
    }
    known = {f.name for f in config.RAW_SCHEMA.fields}
    passed = [F.col(c) for c in raw.columns if c not in known]
    flags = [F.lit(False).alias(f) for f in DUPLICATE_FLAGS if f not in raw.columns]
    return raw.select(*[c.alias(n) for n, c in cleaned.items()], *passed, *flags)


def _outside(column: str, domain) -> Column:
    c = F.col(column)
    return c.isNull() | ~c.isin(*domain)


def quality_rules(b: RuleBounds) -> dict[str, Column]:
    """Rule name -> condition that rejects a row; order defines the reason text."""
    c = F.col
    from_, until = (F.lit(t).cast("timestamp_ntz") for t in (b.ts_from, b.ts_until))
    return {
        "id_nulo": c("transaction_id").isNull() | c("customer_id").isNull(),
        "duplicata_id": c("repete_id"),
        "duplicata_conteudo": c("repete_conteudo"),
        "valor_invalido": c("amount").isNull()
        | (c("amount") <= 0)
        | (c("amount") > b.amount_max),
        "timestamp_invalido": c("ts").isNull() | (c("ts") < from_) | (c("ts") >= until),
        "tipo_fora_dominio": _outside("transaction_type", config.TRANSACTION_TYPES),
        "canal_fora_dominio": _outside("channel", config.CHANNELS),
        "categoria_fora_dominio": _outside("merchant_category", config.CATEGORIES),
        "status_fora_dominio": _outside("status", config.STATUSES),
        "segmento_fora_dominio": _outside("segment", config.SEGMENTS),
        "risk_score_invalido": c("risk_score").isNull()
        | ~c("risk_score").between(b.risk_min, b.risk_max),
        "credit_score_invalido": c("credit_score").isNull()
        | ~c("credit_score").between(b.credit_min, b.credit_max),
        "cliente_fora_faixa": ~c("customer_id").between(b.customer_min, b.customer_max),
        "rotulo_invalido": c("is_fraud").isNull(),
    }


def evaluate(staged: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add ``motivo``: the broken rules joined by ';', empty for a valid row."""
    broken = [F.when(cond, F.lit(name)) for name, cond in rules.items()]
    return staged.withColumn("motivo", F.concat_ws(";", *broken))


def rule_hits(staged: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows broken per rule, all rules counted in a single pass."""
    tallies = F.array(
        *[
            F.struct(
                F.lit(i).alias("ordem"),
                F.lit(name).alias("regra"),
                F.count_if(cond).alias("linhas"),
            )
            for i, (name, cond) in enumerate(rules.items(), start=1)
        ]
    )
    return staged.agg(tallies.alias("t")).select(F.inline("t"))


FLAGS = ("flag_valor_no_piso", "flag_score_no_limite", "flag_fraude_aprovada")


def with_flags(evaluated: DataFrame) -> DataFrame:
    """Add the remarks an analyst should know about an otherwise valid row."""
    c = F.col
    remarks = (
        c("amount") == 5.0,
        c("credit_score").isin(300, 900),
        c("is_fraud") & (c("status") == "approved"),
    )
    partitions = [p for p in ("year", "month") if p in evaluated.columns]
    return evaluated.select(
        *CLEAN_COLUMNS, *[r.alias(f) for f, r in zip(FLAGS, remarks)], "motivo", *partitions
    )


def flag_totals(bronze: DataFrame) -> DataFrame:
    return bronze.agg(
        F.count_if("flag_valor_no_piso").alias("valor_no_piso"),
        F.count_if("flag_score_no_limite").alias("credit_score_no_limite"),
        F.count_if("flag_fraude_aprovada").alias("fraude_com_status_aprovado"),
    )


def attribute_consistency(df: DataFrame, entity: list[str], attribute: str) -> DataFrame:
    """How many entities carry more than one value of an attribute.

    Distinct pairs are formed before grouping by entity, so an entity owning a
    large share of the rows shrinks to its distinct values map-side.
    """
    per_entity = (
        df.select(*entity, attribute)
        .distinct()
        .groupBy(*entity)
        .agg(F.count(attribute).alias("valores"))
    )
    return per_entity.agg(
        F.count("*").alias("entidades"),
        F.count_if(F.col("valores") > 1).alias("entidades_inconsistentes"),
    )


def time_granularity(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.agg(
        F.count_distinct(F.minute(ts)).alias("minutos_distintos"),
        F.count_distinct(F.second(ts)).alias("segundos_distintos"),
    )


def outcome_matrix(expected: DataFrame, obtained: DataFrame, key: str) -> DataFrame:
    """Expected against obtained outcome per fault.

    A row missing from ``obtained`` counts as ``'ausente'``; an unexpected row
    shows up under a NULL fault.
    """
    e = expected.select(key, "falha", "esperado")
    o = obtained.select(key, F.col("resultado").alias("obtido"))
    got = F.coalesce("obtido", F.lit("ausente"))
    return (
        e.join(o, key, "full_outer")
        .groupBy("falha", "esperado")
        .agg(
            F.count("*").alias("linhas"),
            F.count_if(F.col("esperado").eqNullSafe(got)).alias("conformes"),
        )
    )
