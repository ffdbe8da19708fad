"""Load and maintenance jobs, each writing into its own folder of the work area."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from risklake.config import MARTS
from risklake.functions.numeric import cents, from_cents
from risklake.operators.enrich import silver
from risklake.operators.labels import apply_late_labels, label_changes
from risklake.operators.metrics import mart_deltas, merged_mart
from risklake.plans.lakehouse import BRONZE, Lake
from risklake.sources import incremental as inc
from risklake.sources import raw_files
from risklake.sources.layers import (
    MONTHLY,
    append_layer,
    compact,
    file_report,
    layer_sizes,
    read_layer,
    reprocess,
    row_funnel,
    write_layer,
    write_small,
)

_RUN = itertools.count(1)


def fresh(lake: Lake, job: str) -> str:
    """A new folder per run, so results already handed out stay readable."""
    return lake.path(f"work/{job}-{next(_RUN)}")


def _raw_rows(lake: Lake) -> DataFrame:
    return lake.raw.drop(*MONTHLY)


def csv_round_trip(lake: Lake) -> DataFrame:
    """Raw rows written as CSV files and scanned back under the declared schema."""
    path = fresh(lake, "csv")
    raw_files.write_raw_csv(_raw_rows(lake), path)
    return raw_files.read_raw(lake.spark, path)[0]


def rejected_cells(lake: Lake) -> DataFrame:
    """All raw rows as CSV with unparsable numbers planted, and the cells refused."""
    path = fresh(lake, "csv-sujo")
    id_ = F.col("transaction_id")
    text = _raw_rows(lake)
    text = text.select(*[F.col(c).cast("string").alias(c) for c in text.columns])
    planted = text.withColumns(
        {
            "amount": F.when(id_.cast("bigint") % 701 == 0, F.lit("abc")).otherwise(
                F.col("amount")
            ),
            "credit_score": F.when(id_.cast("bigint") % 503 == 0, F.lit("n/d")).otherwise(
                F.col("credit_score")
            ),
        }
    )
    raw_files.write_raw_csv(planted, path)
    rejects = raw_files.read_raw(lake.spark, path)[1]
    return rejects.select(id_.cast("bigint").alias("transaction_id"), "coluna", "valor")


def landing(lake: Lake) -> DataFrame:
    src, dst = fresh(lake, "origem"), fresh(lake, "landing")
    raw_files.write_raw_csv(_raw_rows(lake), src)
    raw_files.land_copy(lake.spark, src, dst)
    return raw_files.reconcile_bytes(lake.spark, src, dst)


def partition_counts(lake: Lake) -> DataFrame:
    return lake.raw.groupBy("year", "month").agg(F.count("*").alias("linhas"))


def one_month(lake: Lake, year: int, month: int) -> DataFrame:
    """Counts for one month; the partition filter leaves the other folders unread."""
    picked = lake.raw.where((F.col("year") == year) & (F.col("month") == month))
    return picked.groupBy("year", "month").agg(F.count("*").alias("linhas"))


def pruning_evidence(lake: Lake, year: int, month: int) -> DataFrame:
    """What a month's filter reads: files its rows came from, files of other months among them, and
    whether that is fewer than the layer lists."""
    own = F.col("_metadata.file_path").contains(f"/year={year}/month={month}/")
    picked = lake.raw.where((F.col("year") == year) & (F.col("month") == month))
    opened = picked.groupBy(F.col("_metadata.file_path").alias("arquivo"), own.alias("proprio")).agg(F.count("*").alias("linhas"))
    read = opened.agg(
        F.sum("linhas").alias("linhas"), F.count_if(~F.col("proprio")).alias("arquivos_de_outros_meses"),
        F.count("*").alias("_lidos"),
    )
    listed = layer_sizes(lake.spark, {"raw": lake.path("raw_particionada")}).select(F.col("arquivos").alias("_total"))
    return read.join(F.broadcast(listed)).select(
        "linhas", "arquivos_de_outros_meses",
        ((F.col("_lidos") > 0) & (F.col("_lidos") < F.col("_total"))).alias("leu_menos_arquivos"),
    )


def multiline_cells(lake: Lake) -> DataFrame:
    """All raw rows as CSV with line breaks, commas and quotes planted in a cell, scanned back."""
    path = fresh(lake, "csv-quebras")
    raw_files.write_raw_csv(_with_breaks(_raw_rows(lake)), path)
    return raw_files.read_raw(lake.spark, path)[0].select("transaction_id", "segment", "credit_score", "is_fraud")


def multiline_rejects(lake: Lake) -> DataFrame:
    """The same with unparsable numbers: one reject for each such cell, none for a line break."""
    path = fresh(lake, "csv-quebras-sujo")
    text = _with_breaks(_raw_rows(lake))
    text = text.select(*[F.col(c).cast("string").alias(c) for c in text.columns])
    number = F.col("transaction_id").cast("bigint")
    bad = F.when(number % 701 == 0, F.lit("n/d")).otherwise(F.col("credit_score"))
    raw_files.write_raw_csv(text.withColumn("credit_score", bad), path)
    rejects = raw_files.read_raw(lake.spark, path)[1]
    return rejects.select(F.col("transaction_id").cast("bigint").alias("transaction_id"), "coluna", "valor")


def _with_breaks(rows: DataFrame) -> DataFrame:
    """Every 97th transaction's segment runs over three lines, with a comma and a quote in it."""
    broken = F.concat(F.lit('a,"b"\n,"c,\n'), F.col("segment"))
    return rows.withColumn("segment", F.when(F.col("transaction_id") % 97 == 0, broken).otherwise(F.col("segment")))


def incremental_load(lake: Lake, first_until: str) -> DataFrame:
    """A first load, then an append of all that it lacked.

    The first load holds the rows before an instant and half of those of the last
    instant before it, so that the second meets rows tied with the mark.
    """
    target = fresh(lake, "incremental")
    src = lake.raw
    early = src.where(F.col("timestamp") < F.lit(first_until).cast("timestamp_ntz"))
    last = early.agg(F.max("timestamp").alias("v")).scalar()
    late = (F.col("timestamp") == last) & (F.col("transaction_id") % 2 == 0)
    write_layer(early.where(~F.coalesce(late, F.lit(False))), target, MONTHLY)
    loaded = read_layer(lake.spark, target)
    before = loaded.groupBy(*MONTHLY).agg(F.count("*").alias("linhas_iniciais"))
    delta = inc.incremental(src, loaded, "timestamp")
    kept = fresh(lake, "incremental-inicial")
    write_layer(before, kept, spread=False)
    append_layer(delta, target)
    after = (
        read_layer(lake.spark, target).groupBy(*MONTHLY).agg(F.count("*").alias("linhas_finais"))
    )
    first = F.coalesce("linhas_iniciais", F.lit(0))
    return after.join(read_layer(lake.spark, kept), list(MONTHLY), "left").select(
        *MONTHLY,
        first.alias("linhas_iniciais"),
        (F.col("linhas_finais") - first).alias("linhas_incrementais"),
    )


def _fraud_by_month(df: DataFrame) -> DataFrame:
    return df.groupBy(*MONTHLY).agg(
        F.count("*").alias("transacoes"),
        F.count_if("is_fraud").alias("fraudes"),
        from_cents(F.sum(cents(F.col("amount")))).alias("valor_total"),
    )


def reprocess_months(lake: Lake, year: int, months: tuple[int, ...]) -> DataFrame:
    """Months loaded with wrong labels are rebuilt from Bronze; others stay as they are."""
    path = fresh(lake, "reprocesso")
    affected = (F.col("year") == year) & F.col("month").isin(*months)
    stale = lake.silver.withColumn(
        "is_fraud", F.when(affected, F.lit(False)).otherwise(F.col("is_fraud"))
    )
    write_layer(stale, path, MONTHLY, spread=False)
    reprocess(silver(lake.bronze.where(affected)), path)
    return _fraud_by_month(read_layer(lake.spark, path))


def chargebacks(lake: Lake, year: int) -> DataFrame:
    """Late labels: high-score refusals of a year confirmed as fraud; web ones revoked later."""
    hit = lake.silver.where(
        (F.col("year") == year) & F.col("recusada") & ~F.col("is_fraud")
        & (F.col("risk_score") >= 80)
    )
    confirmed = F.struct(F.lit(True).alias("r"), F.lit(20).alias("d"))
    revoked = F.struct(F.lit(False).alias("r"), F.lit(40).alias("d"))
    steps = F.when(F.col("channel") == "web", F.array(revoked, confirmed)).otherwise(
        F.array(confirmed)
    )
    return hit.select("transaction_id", "ts", *MONTHLY, F.inline(steps)).select(
        "transaction_id",
        *MONTHLY,
        F.col("r").alias("is_fraud"),
        (F.col("ts") + F.make_dt_interval(days="d")).alias("rotulado_em"),
    )


def late_labels(lake: Lake, year: int) -> DataFrame:
    """Apply late labels to a Silver copy, rewriting only the months they touch.

    The new months are written aside first: a partition overwrite that fails
    midway can be repeated from them.
    """
    path, staged = fresh(lake, "silver-rotulos"), fresh(lake, "meses-rotulados")
    write_layer(lake.silver, path, MONTHLY, spread=False)
    updated = apply_late_labels(read_layer(lake.spark, path), chargebacks(lake, year))
    write_layer(updated, staged, MONTHLY)
    write_layer(read_layer(lake.spark, staged), path, MONTHLY, spread=False, dynamic=True)
    return _fraud_by_month(read_layer(lake.spark, path))


def corrections(lake: Lake, year: int) -> DataFrame:
    """The late labels of a year, and frauds at points of sale that prove to be none."""
    cleared = lake.silver.where((F.col("year") == year) & F.col("is_fraud") & (F.col("channel") == "pos"))
    return chargebacks(lake, year).unionByName(
        cleared.select(
            "transaction_id", *MONTHLY, F.lit(False).alias("is_fraud"),
            (F.col("ts") + F.make_dt_interval(days=F.lit(30))).alias("rotulado_em"),
        )
    )


def labelled_gold(lake: Lake, labels: DataFrame) -> dict[str, DataFrame]:
    """Gold after late labels, by signed changes instead of a rebuild.

    The changed rows are written aside before anything else, so that Silver and Gold
    move by the same changes however often a step is repeated. Marts are merged into
    folders of their own: one that is read is never overwritten.
    """
    aside, deltas = fresh(lake, "mudancas"), fresh(lake, "deltas")
    write_layer(label_changes(lake.silver, labels), aside)
    write_layer(mart_deltas(read_layer(lake.spark, aside)), deltas, ("mart",), spread=False)
    gold = fresh(lake, "gold-rotulos")
    for name in MARTS:
        write_small(merged_mart(lake.mart(name), read_layer(lake.spark, deltas), name), f"{gold}/{name}")
    return {name: read_layer(lake.spark, f"{gold}/{name}") for name in MARTS}


def labelled_cube(lake: Lake, year: int) -> DataFrame:
    return labelled_gold(lake, corrections(lake, year))["gold_cubo_risco"]


def labelled_totals(lake: Lake, year: int) -> DataFrame:
    """Rows and sums of every mart after late labels."""
    rows = None
    for name, df in labelled_gold(lake, corrections(lake, year)).items():
        one = df.agg(
            F.lit(name).alias("mart"), F.count("*").alias("linhas"), F.sum("transacoes").alias("transacoes"),
            F.sum("fraudes").alias("fraudes"), F.sum("recusas_legitimas").alias("recusas_legitimas"),
            F.sum(cents(F.col("valor_fraude"))).alias("centavos_fraude"),
        )
        rows = one if rows is None else rows.unionByName(one)
    return rows


def compacted(lake: Lake, loads: int = 4) -> DataFrame:
    """A copy of raw as several small loads leave it, before and after compaction."""
    src, dst = fresh(lake, "fragmentado"), fresh(lake, "compactado")
    load = F.pmod(F.xxhash64("transaction_id", "timestamp"), F.lit(loads))
    for k in range(loads):
        append_layer(lake.raw.where(load == k), src)
    compact(lake.spark, src, dst)
    before, after = file_report(lake.spark, src), file_report(lake.spark, dst)
    before = before.withColumnsRenamed({"arquivos": "arquivos_antes", "linhas": "linhas_antes"})
    after = after.select(
        *[F.col(c).alias(f"_{c}") for c in MONTHLY],
        F.col("arquivos").alias("arquivos_depois"),
        F.col("linhas").alias("linhas_depois"),
    )
    same = F.lit(True)
    for c in MONTHLY:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return before.join(after, same, "full_outer").select(
        *[F.coalesce(c, f"_{c}").alias(c) for c in MONTHLY],
        "arquivos_antes", "linhas_antes", "arquivos_depois", "linhas_depois",
    )


LAYER_FOLDERS = {
    "raw_particionada": "raw_particionada",
    "bronze": BRONZE,
    "quarentena": "quarentena",
    "silver": "silver/transactions",
    "gold": "gold",
}


def sizes(lake: Lake) -> DataFrame:
    return layer_sizes(lake.spark, {n: lake.path(p) for n, p in LAYER_FOLDERS.items()})


def funnel(lake: Lake) -> DataFrame:
    return row_funnel(
        {
            "raw_particionada": lake.raw,
            "bronze": lake.bronze,
            "quarentena": lake.quarantine,
            "silver": lake.silver,
            **lake.marts(),
        }
    )
