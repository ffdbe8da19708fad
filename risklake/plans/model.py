"""Interpretable fraud model on Silver: features, split, fit, evaluation."""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression, GeneralizedLinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from risklake.config import INDICATORS, NUMERIC_FEATURES
from risklake.functions.numeric import round_half
from risklake.operators.ranking import auc, separation
from risklake.plans.lakehouse import Lake
from risklake.session import work_dir
from risklake.sources.layers import write_layer

FEATURES = (*INDICATORS, *NUMERIC_FEATURES)
SPLIT_SALT = "42"
TRAIN_PERCENT = 80
_FIT = itertools.count(1)


def features(silver: DataFrame) -> DataFrame:
    """Indicators and scaled numerics in one projection.

    Status is left out: every fraud is declined, so it would leak the label.
    """
    c = F.col
    dummies = [(c(col) == level).cast("double").alias(n) for n, (col, level) in INDICATORS.items()]
    scaled = {
        "risk_score_10pts": c("risk_score") / F.lit(10.0),
        "credit_score_100pts": c("credit_score").cast("double") / F.lit(100.0),
        "log_valor": F.ln("amount"),
    }
    return silver.select(
        "transaction_id",
        "is_fraud",
        "risk_score",
        c("is_fraud").cast("double").alias("label"),
        *dummies,
        *[scaled[n].alias(n) for n in NUMERIC_FEATURES],
    )


def hash_percent(id_: str, salt: str = SPLIT_SALT) -> Column:
    """A stable 0..99 draw per id, independent of layout and engine."""
    digest = F.md5(F.concat(F.col(id_).cast("string"), F.lit(f"|{salt}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100


def hash_split(
    df: DataFrame, id_: str = "transaction_id", pct: int = TRAIN_PERCENT, salt: str = SPLIT_SALT
) -> tuple[DataFrame, DataFrame]:
    train = hash_percent(id_, salt) < pct
    return df.where(train), df.where(~train)


def split_summary(df: DataFrame, id_: str = "transaction_id") -> DataFrame:
    """Rows, positives and an id checksum of both sides in one aggregation."""
    side = F.when(hash_percent(id_) < TRAIN_PERCENT, F.lit("treino")).otherwise(F.lit("teste"))
    return df.groupBy(side.alias("parte")).agg(
        F.count("*").alias("linhas"),
        F.count_if("is_fraud").alias("fraudes"),
        F.expr(f"bit_xor({id_})").alias("xor_ids"),
    )


def estimator(columns: Sequence[str] = FEATURES) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features")
    logistic = LogisticRegression(
        featuresCol="features", labelCol="label", regParam=0.0, maxIter=200
    )
    return Pipeline(stages=[assembler, logistic])


def fit(train: DataFrame, columns: Sequence[str] = FEATURES) -> PipelineModel:
    return estimator(columns).fit(train)


def stored_model(model: PipelineModel, path: str) -> PipelineModel:
    """The model as read back: coefficients alone, without the rows and summary of its training."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    scored = model.transform(df)
    return scored.withColumn("p_fraude", vector_to_array("probability")[1])


def fit_glm(
    train: DataFrame, columns: Sequence[str] = FEATURES
) -> GeneralizedLinearRegressionModel:
    """The same model as a binomial GLM, which also yields standard errors.

    Its rounds pass over the assembled rows, which are held meanwhile as the logistic fit holds its own.
    """
    assembled = VectorAssembler(inputCols=list(columns), outputCol="features").transform(train)
    rows = assembled.select("features", "label").persist(StorageLevel.MEMORY_AND_DISK)
    fitted = GeneralizedLinearRegression(
        family="binomial", link="logit", featuresCol="features", labelCol="label", maxIter=50
    ).fit(rows)
    rows.unpersist()
    return fitted


def odds_ratios(
    spark: SparkSession, glm: GeneralizedLinearRegressionModel, columns: Sequence[str] = FEATURES
) -> DataFrame:
    """Coefficient, odds ratio, 95 % interval and p-value per input.

    The summary arrays carry the intercept after the inputs.
    """
    summary = glm.summary
    errors, p_values = summary.coefficientStandardErrors, summary.pValues
    rows = [
        (name, float(b), float(se), float(p))
        for name, b, se, p in zip(
            [*columns, "intercepto"], [*glm.coefficients, glm.intercept], errors, p_values
        )
    ]
    coef, margin = F.col("coeficiente"), F.lit(1.96) * F.col("erro_padrao")
    table = spark.createDataFrame(
        rows, "variavel string, coeficiente double, erro_padrao double, p_valor double"
    )
    return table.select(
        "variavel",
        "coeficiente",
        "erro_padrao",
        F.exp(coef).alias("odds_ratio"),
        F.exp(coef - margin).alias("ic95_inf"),
        F.exp(coef + margin).alias("ic95_sup"),
        "p_valor",
    )


def evaluation(scored: DataFrame) -> DataFrame:
    """Model against the current risk score on unseen rows."""
    areas = separation(scored, ["p_fraude", "risk_score"], "is_fraud")
    pos = F.col("positivos").cast("double")
    return areas.select("*", (pos / (pos + F.col("negativos"))).alias("taxa_base"))


def cross_validated(df: DataFrame, folds: int = 3) -> DataFrame:
    """Mean and spread of the exact ROC area over id-hashed folds.

    One fold after the other is left out; each fit is a distributed job of its own, and
    all left-out rows are scored and ranked together, by models that were
    stored and read back, so that tasks carry coefficients and not a training's summary.
    """
    run = f"{work_dir(df.sparkSession)}/modelos/{next(_FIT)}"
    folded = df.withColumn("_fold", (hash_percent("transaction_id", "fold") % folds).cast("int"))
    scored = []
    for k in range(folds):
        fitted = stored_model(fit(folded.where(F.col("_fold") != k)), f"{run}-{k}")
        left_out = score(fitted, folded.where(F.col("_fold") == k))
        scored.append(left_out.select("_fold", "is_fraud", "p_fraude"))
    areas = auc(reduce(DataFrame.unionByName, scored), ["p_fraude"], "is_fraud", by=["_fold"])
    return areas.agg(
        F.count("auc").cast("int").alias("dobras"),
        round_half(F.avg("auc"), 6).alias("auc_media"),
        round_half(F.stddev_pop("auc"), 6).alias("auc_desvio"),
    )


def _inputs(columns: Sequence[str]) -> list[Column]:
    """The model's inputs with the intercept's constant first."""
    return [F.lit(1.0), *(F.col(c) for c in columns)]


def score_balance(scored: DataFrame, columns: Sequence[str] = FEATURES, tolerance: float = 1e-4) -> DataFrame:
    """Certificate of the fit, without any knowledge of how it was found.

    At the maximum of the likelihood, and only there, predicted and observed sums of
    every input agree over the rows it was fitted on. One row per input.
    """
    names, x = ["intercepto", *columns], _inputs(columns)
    sums = scored.agg(
        *[F.sum(v * F.col("label")).alias(f"o{i}") for i, v in enumerate(x)],
        *[F.sum(v * F.col("p_fraude")).alias(f"p{i}") for i, v in enumerate(x)],
    )
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("variavel"), F.col(f"o{i}").alias("o"), F.col(f"p{i}").alias("p"))
            for i, n in enumerate(names)
        ]
    )
    near = F.abs(F.col("o") - F.col("p")) <= F.lit(tolerance) * F.greatest(F.abs("o"), F.lit(1.0))
    return sums.select(F.inline(rows)).select(
        "variavel", round_half(F.col("o"), 2).alias("soma_observada"), near.alias("equilibrada")
    )


def information_errors(df: DataFrame, coefficients: dict[str, float]) -> dict[str, float]:
    """Standard errors from the inverse of the information matrix at the coefficients, intercept first.

    Each task adds up the matrix of its rows, one row and column per input; only such
    matrices are shuffled, and their sum comes to the driver.
    """
    columns, at = list(coefficients)[1:], np.array(list(coefficients.values()))
    size = len(at)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = np.zeros((size, size))
        for batch in batches:
            x = np.stack([np.ones(len(batch)), *(c.to_numpy(zero_copy_only=False) for c in batch.columns)], 1)
            p = 1.0 / (1.0 + np.exp(-(x @ at)))
            matrix += (x * (p * (1.0 - p))[:, None]).T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size)), pa.array(matrix.ravel())], names=["cell", "part"])

    parts = df.select(*columns).mapInArrow(task, "cell long, part double")
    cells = parts.groupBy("cell").agg(F.sum("part").alias("value")).orderBy("cell").toArrow()
    errors = np.sqrt(np.diag(np.linalg.inv(cells["value"].to_numpy().reshape(size, size))))
    return dict(zip(coefficients, errors.tolist(), strict=True))


def odds_ratios_check(lake: Lake, tolerance: float = 1e-3) -> DataFrame:
    """The GLM's coefficients and errors beside those of the logistic model and its information matrix."""
    fitted = lake_model(lake)
    logistic = fitted.stages[-1]
    mine = dict(zip(["intercepto", *FEATURES], [logistic.intercept, *logistic.coefficients.toArray()], strict=True))
    errors = information_errors(feature_table(lake, True), mine)
    rows = lake.spark.createDataFrame(
        [(n, float(mine[n]), errors[n]) for n in mine], "variavel string, _coeficiente double, _erro double"
    )
    c = F.col
    same_value = F.abs(c("coeficiente") - c("_coeficiente")) <= F.lit(tolerance) * c("erro_padrao")
    same_error = F.abs(c("erro_padrao") - c("_erro")) <= F.lit(tolerance) * c("erro_padrao")
    inside = (c("ic95_inf") < c("odds_ratio")) & (c("odds_ratio") < c("ic95_sup"))
    return odds_ratios(lake.spark, lake_glm(lake)).join(rows, "variavel").select(
        "variavel", same_value.alias("coeficiente_confere"), same_error.alias("erro_confere"), inside.alias("intervalo_confere")
    )


def with_interaction(df: DataFrame) -> DataFrame:
    return df.withColumn("app_x_viagem", F.col("canal_app") * F.col("cat_viagem"))


# -- over a lake -------------------------------------------------------------

# Keyed by lake folder and build.
_READY: set[tuple[str, int]] = set()
_MODELS: dict[tuple[str, int], PipelineModel] = {}
_GLMS: dict[tuple[str, int, bool], GeneralizedLinearRegressionModel] = {}


def feature_table(lake: Lake, train: bool | None = None) -> DataFrame:
    """Features written once, one folder per side of the split.

    Iterative training then rereads a compact table instead of recomputing the
    lineage, and the filter on the side prunes folders.
    """
    path, key = lake.path("work/features"), (lake.root, lake.version)
    if key not in _READY:
        df = features(lake.silver).withColumn(
            "treino", hash_percent("transaction_id") < TRAIN_PERCENT
        )
        write_layer(df, path, ("treino",), spread=False)
        _READY.add(key)
    df = lake.layer("work/features")
    return df if train is None else df.where(F.col("treino") == F.lit(train))


def lake_model(lake: Lake) -> PipelineModel:
    path, key = lake.path("work/model"), (lake.root, lake.version)
    if key not in _MODELS:
        _MODELS[key] = stored_model(fit(feature_table(lake, True)), path)
    return _MODELS[key]


def lake_glm(lake: Lake, interaction: bool = False) -> GeneralizedLinearRegressionModel:
    key = (lake.root, lake.version, interaction)
    if key not in _GLMS:
        train = feature_table(lake, True)
        columns = [*FEATURES, "app_x_viagem"] if interaction else FEATURES
        _GLMS[key] = fit_glm(with_interaction(train) if interaction else train, columns)
    return _GLMS[key]


def scored_silver(lake: Lake) -> DataFrame:
    """Fraud probability of every Silver transaction."""
    return score(lake_model(lake), features(lake.silver)).select("transaction_id", "p_fraude")


def scored_test(lake: Lake) -> DataFrame:
    return score(lake_model(lake), feature_table(lake, False)).select(
        "transaction_id", "is_fraud", "risk_score", "p_fraude"
    )


def score_certificate(lake: Lake) -> DataFrame:
    """Balance of the model over the rows it was fitted on."""
    return score_balance(score(lake_model(lake), feature_table(lake, True)))
