"""URL filters: rules first, then gradient-boosted trees on lexical features.

The rules label the URLs they fit. Trees learn from those labels what blocked URLs
look like and judge the URLs that no rule fits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from risklake.llm.scratch import kept
from risklake.llm.words import ARROW_ROWS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLDS = 5
PRIOR_WEIGHT = 20.0
SAMPLE_ROWS = 200_000
LEXICAL = (
    "url_chars host_chars path_chars depth labels digit_ratio host_digit_ratio symbol_ratio "
    "entropy host_entropy hyphens parameters query_chars fragment secure longest_part"
).split()
STATISTICS = ("tld_rate", "tld_seen", "site_rate", "site_seen", "first_rate", "first_seen")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def _behind_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    """What stands between ``://`` and the next /, ? or #, in lower case; empty without ``://``."""
    host = F.regexp_extract(_behind_scheme(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What stands between the host and the next ? or #."""
    return F.coalesce(F.regexp_extract(_behind_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(rules: tuple[Rule, ...], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, NULL where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _entropy(data: bytes) -> float:
    counts = np.bincount(np.frombuffer(data, np.uint8))
    share = counts[counts > 0] / max(len(data), 1)
    return float(-(share * np.log2(share)).sum())


def _lexical(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    digits = bytes(b for b in range(256) if not 48 <= b <= 57)
    letters = bytes(b for b in range(256) if chr(b).isalnum() and b < 128)
    for pdf in batches:
        rows = []
        for url, host, path in zip(pdf["url"], pdf["host"], pdf["path"], strict=True):
            u, h, p = (x.encode("utf-8", "replace") for x in (url or "", host, path))
            query = u.partition(b"?")[2].partition(b"#")[0]
            parts = p.strip(b"/").split(b"/")
            n = max(len(u), 1)
            rows.append(
                (
                    len(u), len(h), len(p), p.count(b"/"), h.count(b".") + 1,
                    len(u.translate(None, digits)) / n, len(h.translate(None, digits)) / max(len(h), 1),
                    len(u.translate(None, letters)) / n, _entropy(u), _entropy(h), h.count(b"-"),
                    query.count(b"&") + bool(query), len(query), b"#" in u, u.startswith(b"https"),
                    max(map(len, parts)),
                )
            )
        values = np.array(rows, np.float64).reshape(len(rows), len(LEXICAL))
        yield pd.concat(
            [pdf.reset_index(drop=True), pd.DataFrame(values, columns=list(LEXICAL))], axis=1
        )


def _suffixes(df: DataFrame) -> DataFrame:
    """The keys whose label statistics become features: last host label, last two, first path part."""
    labels = F.split("host", r"\.")
    return df.select(
        "*",
        F.element_at(labels, -1).alias("tld"),
        F.array_join(F.slice(F.concat(F.array(F.lit("")), labels), -2, 2), ".").alias("site"),
        F.regexp_extract("path", "^/([^/]*)", 1).alias("first"),
    )


def _with_statistics(df: DataFrame, key: str) -> DataFrame:
    """Block rate and number of labelled rows for the key, from the other folds than the row's own.

    Counts are summed before they are joined; rows without label have fold -1 and use all folds.
    """
    labelled = df.filter("label IS NOT NULL")
    own = labelled.groupBy(key, "fold").agg(F.count("*").alias("n"), F.sum("label").alias("y"))
    every = own.groupBy(key).agg(F.sum("n").alias("all_n"), F.sum("y").alias("all_y"))
    n = F.coalesce("all_n", F.lit(0)) - F.coalesce("n", F.lit(0))
    y = F.coalesce("all_y", F.lit(0.0)) - F.coalesce("y", F.lit(0.0))
    rate = (y + PRIOR_WEIGHT * F.col("base_rate")) / (n + PRIOR_WEIGHT)
    return (
        df.join(every, key, "left").join(own, [key, "fold"], "left")
        .withColumns({f"{key}_rate": rate, f"{key}_seen": F.log1p(n)})
        .drop("n", "y", "all_n", "all_y")
    )


def judged(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, trees: int = 12, depth: int = 4,
    sample_rows: int = SAMPLE_ROWS, seed: int = 5,
) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, and the score of the trees.

    ``score`` is the estimated chance that the URL is to be blocked. Where no rule
    fits, a chance of one half or more blocks. The trees are fitted on the labelled
    rows, on a sample of about ``sample_rows`` by hash if there are more; suffix
    statistics and judgements cover all rows. NULL URLs and those without ``://``
    have an empty host and path. If the rules label nothing, or everything alike,
    the score is the share of blocked labels (0 without labels). Needs page_id and
    url; other columns are ignored.
    """
    spark = pages.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS * 8))
    based = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = longest_rule(rules, F.col("host"), F.col("path"))
    ruled = based.withColumns({"rule": rule, "ruled": verdict})
    schema = ruled.select("*").schema
    for name in LEXICAL:
        schema = schema.add(name, "double")
    label = F.when(F.col("ruled").isNotNull(), (F.col("ruled") == "block").cast("double"))
    fold = F.when(F.col("ruled").isNotNull(), F.pmod(F.xxhash64("url"), F.lit(FOLDS))).otherwise(-1).cast("int")
    rows = kept(ruled.mapInPandas(_lexical, schema).withColumns({"label": label, "fold": fold}), "urls")
    n, y = rows.agg(F.count("label"), F.sum("label")).first()
    base_rate = (y or 0.0) / max(n, 1)
    if not 0 < base_rate < 1:
        return _verdicts(rows.withColumn("score", F.lit(base_rate)))
    featured = _suffixes(rows).withColumn("base_rate", F.lit(base_rate))
    for key in ("tld", "site", "first"):
        featured = _with_statistics(featured, key)
    featured = VectorAssembler(inputCols=[*LEXICAL, *STATISTICS], outputCol="features").transform(featured)
    featured = kept(
        featured.select("page_id", "host", "path", "rule", "ruled", "url", "label", "features"), "url-features"
    )
    share = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "url", "page_id"), 11).cast("double") * 2.0**-53
    sample = featured.filter("label IS NOT NULL").filter(share < min(1.0, sample_rows / n)).select("features", "label")
    model = GBTClassifier(maxIter=trees, maxDepth=depth, maxBins=32, stepSize=0.3, seed=seed).fit(sample)
    scored = model.transform(featured).withColumn("score", F.element_at(vector_to_array("probability"), 2))
    return _verdicts(scored)


def _verdicts(scored: DataFrame) -> DataFrame:
    judged = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", judged).alias("verdict"), "score"
    )


def op5_url_filter(spark, sf_dir: str) -> DataFrame:
    return judged(spark.read.parquet(f"{sf_dir}/pages.parquet"))
