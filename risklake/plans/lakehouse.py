"""Building the lakehouse: raw -> Bronze / quarantine -> Silver -> Gold."""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from risklake.config import CLEAN_COLUMNS, GIVEN_TABLES_BOUNDS, MARTS, RuleBounds
from risklake.operators.dedup import duplicate_marks, fits_in_tasks, packed_marks, with_packed
from risklake.operators.enrich import silver
from risklake.operators.metrics import all_marts, pick_mart
from risklake.operators.quality import evaluate, quality_rules, stage, with_flags
from risklake.session import work_dir, written
from risklake.sources.layers import (
    INGEST_ID,
    MONTHLY,
    read_layer,
    with_month,
    write_layer,
    write_numbered,
    write_small,
)
from risklake.sources.raw_files import land_copy, read_raw, reconcile_bytes
from risklake.sources.transactions import raw_transactions, table


# One pass writes valid and rejected rows side by side; the first is Bronze.
BRONZE = "bronze/situacao=valida"


@dataclass
class Lake:
    """Paths of one lakehouse and readers for its layers."""

    spark: SparkSession
    root: str
    bounds: RuleBounds = field(default_factory=RuleBounds)
    source: str | None = None
    #: Counts the builds, so that what was derived from an earlier one is not used again.
    version: int = 0

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def layer(self, name: str) -> DataFrame:
        return read_layer(self.spark, self.path(name))

    def given(self, name: str) -> DataFrame:
        """One of the given tables the lake was built from."""
        return table(self.spark, self.source, name)

    @property
    def raw(self) -> DataFrame:
        """Raw rows as delivered, without the number they got when loaded."""
        return self.layer("raw_particionada").drop(INGEST_ID)

    @property
    def bronze(self) -> DataFrame:
        """Valid rows; none where every row was rejected."""
        rows = self.layer("bronze").where(F.col("situacao") == "valida")
        return rows.drop("situacao", "motivo")

    @property
    def quarantine(self) -> DataFrame:
        return self.layer("quarentena")

    @property
    def silver(self) -> DataFrame:
        return self.layer("silver/transactions")

    def mart(self, name: str) -> DataFrame:
        return self.layer(f"gold/{name}")

    @property
    def cube(self) -> DataFrame:
        return self.mart("gold_cubo_risco")

    def marts(self) -> dict[str, DataFrame]:
        return {name: self.mart(name) for name in MARTS}

    def marked(self) -> DataFrame:
        """Raw rows with their duplicate flags, from the written marks."""
        return with_packed(self.layer("raw_particionada"), self.layer("work/marcas"))

    def staged(self) -> DataFrame:
        return stage(self.marked())

    # -- build steps -------------------------------------------------------

    def load_raw(self, raw: DataFrame, spread: bool = True) -> None:
        write_numbered(with_month(raw), self.path("raw_particionada"), spread=spread)

    def mark_duplicates(self) -> None:
        """Written once, so rule evaluation and rule counts share the result."""
        marks = duplicate_marks(self.layer("raw_particionada"), keys_only=self.raw)
        write_layer(marks, self.path("work/duplicatas"), spread=False)
        write_layer(packed_marks(self.layer("work/duplicatas")), self.path("work/marcas"), spread=False)

    def refine(self) -> None:
        """Evaluate every raw row once and file it as valid or rejected.

        The marks come to the rows, so Bronze takes over raw's files, a month each;
        only marks too many to send move the rows, which are then rebalanced.
        Rejected rows, few per input file, are packed into quarantine files as scan
        tasks pack the small files that hold them.
        """
        evaluated = evaluate(self.staged(), quality_rules(self.bounds))
        situation = F.when(F.col("motivo") == "", F.lit("valida")).otherwise(F.lit("rejeitada"))
        write_layer(
            with_flags(evaluated).withColumn("situacao", situation),
            self.path("bronze"),
            ("situacao", *MONTHLY),
            spread=not fits_in_tasks(self.layer("work/marcas")),
        )
        rejected = self.layer("bronze").where(F.col("situacao") == "rejeitada")
        write_layer(rejected.select(*CLEAN_COLUMNS, "motivo"), self.path("quarentena"), spread=False)

    def build_silver(self) -> None:
        """Row-wise from Bronze; its files are already one month each."""
        write_layer(
            silver(self.bronze), self.path("silver/transactions"), MONTHLY, spread=False
        )

    def build_gold(self) -> None:
        """One scan of Silver for all marts, then a small file per mart."""
        write_layer(all_marts(self.silver), self.path("work/marts"), ("mart",), spread=False)
        sets = self.layer("work/marts")
        for name in MARTS:
            write_small(pick_mart(sets, name), self.path(f"gold/{name}"))

    def build(self, raw: DataFrame) -> Lake:
        self.version += 1
        self.load_raw(raw)
        self.mark_duplicates()
        self.refine()
        self.build_silver()
        self.build_gold()
        return self

    def build_from_csv(self, csv: str) -> DataFrame:
        """Land raw files, prove the copy, keep the rejects, build every layer.

        Returns the proof: line counts on both sides and whether they match.
        """
        landing = self.path("raw/transactions")
        land_copy(self.spark, csv, landing)
        proof = written(reconcile_bytes(self.spark, csv, landing), "landing")
        good, rejects = read_raw(self.spark, landing)
        write_layer(rejects, self.path("raw/rejeitadas"))
        self.build(good)
        return proof


_BUILT: dict[tuple[str, str], Lake] = {}


def lake_for(spark: SparkSession, sf_dir: str) -> Lake:
    """The lakehouse over the given tables, built once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        name = f"{sf_dir.rstrip('/').rsplit('/', 1)[-1]}-{zlib.crc32(sf_dir.encode()):08x}"
        lake = Lake(spark, f"{work_dir(spark)}/{name}", GIVEN_TABLES_BOUNDS, sf_dir)
        _BUILT[key] = lake.build(raw_transactions(spark, sf_dir))
    return _BUILT[key]
