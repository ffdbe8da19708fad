"""From raw documents to token ids in five stages, each written and read again."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from risklake.llm.bpe import decoded, encoded, vocabulary_path
from risklake.llm.mixing import mixed_documents
from risklake.llm.quality import quality
from risklake.llm.scratch import kept
from risklake.llm.shingles import one_of_each
from risklake.llm.substring import without_repeats

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def reject_junk(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated chance of good quality is one half or more."""
    scored = quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.filter(F.col("quality_score") >= 0.5).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a five-word shingle similarity of 0.8 or more."""
    return one_of_each(docs, n=5, share=Fraction(4, 5)).select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of 50-word windows that a document with a smaller id also has.

    Texts that lose nothing stay as they are; documents that lose all words go.
    """
    cut = without_repeats(docs.select(*COLUMNS))
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    left = cut.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    chars = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumns({"text": text, "n_chars": chars}).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of the sources takes it."""
    return mixed_documents(docs.select(*COLUMNS))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, their number, and whether they decode to the very text."""
    path = vocabulary_path()
    given = docs.select("doc_id", "lang", "source", "text", F.coalesce("text", F.lit("")).alias("original"))
    both = decoded(encoded(given, path), path)
    return both.select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"),
        (F.col("decoded") == F.col("original")).alias("exact"),
    )


STAGES = [
    ("quality", reject_junk),
    ("near_copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("mix", mix_sources),
    ("tokens", tokenize),
]

#: Fitted models and random rounding have no SQL twin; tests check each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
