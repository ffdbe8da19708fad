"""Fault injection: every valid row is kept and also delivered once more, broken.

Each row's copy carries one of twelve faults, so all rules are exercised by the
whole data set and the outcome of every copy is known beforehand.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from risklake.config import RAW_SCHEMA
from risklake.operators.quality import evaluate, outcome_matrix, quality_rules
from risklake.plans.lakehouse import Lake
from risklake.sources.raw_files import typed_rows


@dataclass(frozen=True)
class Fault:
    name: str
    outcome: str
    change: dict[str, str] = field(default_factory=dict)
    new_id: bool = True
    same_time: bool = False


# --- fixed values -----------------------------------------------------------
FAULTS = (
    Fault("copia_exata", "duplicata_id;duplicata_conteudo", new_id=False, same_time=True),
    Fault("conteudo_com_outro_id", "duplicata_conteudo", same_time=True),
    Fault("valor_negativo", "valor_invalido", {"amount": "-150.00"}),
    Fault("valor_zero", "valor_invalido", {"amount": "0"}),
    Fault("risk_score_150", "risk_score_invalido", {"risk_score": "150"}),
    Fault("credit_score_1000", "credit_score_invalido", {"credit_score": "1000"}),
    Fault("fora_do_periodo", "timestamp_invalido", {"timestamp": "1970-06-10 10:00:00"}),
    Fault("canal_whatsapp", "canal_fora_dominio", {"channel": "whatsapp"}),
    Fault("rotulo_talvez", "rotulo_invalido", {"is_fraud": "talvez"}),
    Fault("cliente_zero", "cliente_fora_faixa", {"customer_id": "0"}),
    Fault(
        "caixa_e_espacos",
        "aceita app/viagem",
        {"channel": " APP ", "merchant_category": "Viagem"},
    ),
    Fault("valor_texto", "ausente", {"amount": "abc"}),
)
# --- end of fixed values ----------------------------------------------------

NEW_ID_OFFSET = 10**15


def _by_fault(values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("_falha") + 1).cast("int"))


def _faults_with(test) -> Column:
    return F.col("_falha").isin(*[i for i, f in enumerate(FAULTS) if test(f)])


def as_text(bronze: DataFrame) -> DataFrame:
    """Valid rows back in raw text form, each assigned a fault."""
    return bronze.select(
        F.col("transaction_id").alias("_origem"),
        F.pmod("transaction_id", F.lit(len(FAULTS))).alias("_falha"),
        *[
            F.col("ts" if f.name == "timestamp" else f.name).cast("string").alias(f.name)
            for f in RAW_SCHEMA.fields
        ],
    )


def broken_copies(text: DataFrame) -> DataFrame:
    """One faulty copy per row.

    Copies get ids above all others, and a time offset of their own within the
    hour so that they repeat no other content, except where repetition is the
    fault.
    """
    offset = (F.pmod("_origem", F.lit(3_599_000_000)) + 1).cast("decimal(18,0)") / F.lit(
        1_000_000
    ).cast("decimal(18,0)")
    moved = F.col("timestamp").cast("timestamp_ntz") + F.make_dt_interval(secs=offset)
    base = {f.name: F.col(f.name) for f in RAW_SCHEMA.fields}
    base["transaction_id"] = F.when(
        _faults_with(lambda f: f.new_id), (F.col("_origem") + NEW_ID_OFFSET).cast("string")
    ).otherwise(F.col("transaction_id"))
    base["timestamp"] = F.when(
        _faults_with(lambda f: not f.same_time), moved.cast("string")
    ).otherwise(F.col("timestamp"))
    for i, fault in enumerate(FAULTS):
        for column, value in fault.change.items():
            base[column] = F.when(F.col("_falha") == i, F.lit(value)).otherwise(base[column])
    return text.select("_origem", "_falha", *[c.alias(n) for n, c in base.items()])


def rule_matrix(lake: Lake, scratch: str) -> DataFrame:
    """Per fault: copies tested and copies with exactly the expected outcome.

    The doubled data goes through the ordinary load: parsing, the raw layer,
    duplicate marks and rules. Bronze's files are one month each, and copies keep to
    their row's hour or go to one month, so they are loaded without a shuffle.
    """
    text = as_text(lake.bronze)
    trial = Lake(lake.spark, scratch, lake.bounds)
    trial.load_raw(typed_rows(text.unionByName(broken_copies(text))).drop("_falha"), spread=False)
    trial.mark_duplicates()
    evaluated = evaluate(trial.staged(), quality_rules(trial.bounds))
    accepted = F.concat_ws(" ", F.lit("aceita"), F.concat_ws("/", "channel", "merchant_category"))
    obtained = evaluated.where(
        (F.col("transaction_id") >= NEW_ID_OFFSET) | F.col("repete_id")
    ).select(
        "_origem", F.when(F.col("motivo") == "", accepted).otherwise(F.col("motivo")).alias("resultado")
    )
    expected = text.select(
        "_origem",
        _by_fault([f.name for f in FAULTS]).alias("falha"),
        _by_fault([f.outcome for f in FAULTS]).alias("esperado"),
    )
    return outcome_matrix(expected, obtained, "_origem")
