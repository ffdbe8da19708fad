"""The model recovers the planted effects and agrees with its GLM twin."""

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from risklake.plans import model
from risklake.plans.catalog import CATALOG


@pytest.fixture(scope="module")
def odds(spark, medium_lake):
    return {r.variavel: r for r in model.odds_ratios(spark, model.lake_glm(medium_lake)).collect()}


def test_planted_effects(odds):
    for name in ("seg_high_risk", "seg_standard", "canal_app", "cat_viagem", "madrugada"):
        assert odds[name].coeficiente > 0 and odds[name].p_valor < 0.001
        assert odds[name].ic95_inf > 1
    for name in ("risk_score_10pts", "credit_score_100pts", "log_valor"):
        assert odds[name].p_valor > 0.01
    assert odds["seg_high_risk"].coeficiente == pytest.approx(2.40, abs=0.05)
    for r in odds.values():
        assert r.ic95_inf <= r.odds_ratio <= r.ic95_sup


def test_logistic_equals_glm(medium_lake, odds):
    fitted = model.lake_model(medium_lake).stages[-1]
    gaps = [
        abs(b - odds[name].coeficiente) for name, b in zip(model.FEATURES, fitted.coefficients)
    ]
    assert max(gaps) < 1e-3


def test_evaluation_on_unseen_rows(medium_lake):
    scored = model.scored_test(medium_lake)
    got = {r.variavel: r for r in model.evaluation(scored).collect()}
    assert got["p_fraude"].auc == pytest.approx(0.768, abs=0.01)
    assert got["p_fraude"].auc > got["risk_score"].auc + 0.2
    exact = BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="p_fraude", metricName="areaUnderPR", numBins=0
    ).evaluate(scored.withColumn("label", F.col("is_fraud").cast("double")))
    assert got["p_fraude"].auc_pr == pytest.approx(exact, abs=2e-6)


def test_split_ignores_layout(medium_lake):
    silver = medium_lake.silver
    a = model.hash_split(silver)[0].select("transaction_id")
    b = model.hash_split(silver.repartition(5))[0].select("transaction_id")
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    share = a.count() / silver.count()
    assert 0.78 < share < 0.82


def test_status_is_not_a_feature(lake):
    assert "status" not in model.features(lake.silver).columns
    assert len(model.FEATURES) == 17


def test_every_row_is_scored(lake):
    scored = model.scored_silver(lake)
    assert scored.count() == lake.silver.count()
    assert scored.where("p_fraude < 0 OR p_fraude > 1 OR p_fraude IS NULL").count() == 0


def test_stream_scores_equal_batch_scores(lake):
    streamed, batch = CATALOG["stream_score"](lake), model.scored_silver(lake)
    assert streamed.count() == batch.count()
    both = streamed.withColumnRenamed("p_fraude", "s").join(batch, "transaction_id")
    assert both.where(F.abs(F.col("s") - F.col("p_fraude")) < 1e-12).count() == batch.count()


def test_interaction_adds_one_coefficient(medium_lake):
    names = [r.variavel for r in CATALOG["ml_interaction"](medium_lake).collect()]
    assert names == [*model.FEATURES, "app_x_viagem", "intercepto"]


def test_cross_validation_agrees_with_the_held_out_area(medium_lake):
    r = CATALOG["ml_cv"](medium_lake).first()
    assert r.dobras == 3
    assert r.auc_media == pytest.approx(0.768, abs=0.02)
    assert 0 <= r.auc_desvio < 0.03


def test_model_capture_matches_a_full_sort(medium_lake):
    rows = model.scored_test(medium_lake).collect()
    ranked = sorted(rows, key=lambda r: (-r.p_fraude, r.transaction_id))
    for r in CATALOG["capture_top_model"](medium_lake).collect():
        k = round(len(rows) * r.fatia)
        assert r.transacoes_revisadas == k
        assert r.fraudes == sum(x.is_fraud for x in ranked[:k])


def test_cross_validation_is_stable_over_reruns(lake):
    found = [CATALOG["ml_cv"](lake).first() for _ in range(3)]
    assert found[0] == found[1] == found[2] and found[0].dobras == 3


def test_balance_notices_another_model(medium_lake):
    rows = model.score(model.lake_model(medium_lake), model.feature_table(medium_lake, True))
    assert all(r.equilibrada for r in model.score_balance(rows).collect())
    off = rows.withColumn("p_fraude", F.col("p_fraude") * 1.01)
    assert not any(r.equilibrada for r in model.score_balance(off).collect())


def test_folds_are_scored_by_stored_models(lake, monkeypatch):
    """A fitted model drags its training along into the tasks that score with it."""
    used, score = [], model.score
    monkeypatch.setattr(model, "score", lambda fitted, df: used.append(fitted.stages[-1].hasSummary) or score(fitted, df))
    model.cross_validated(model.feature_table(lake))
    assert used == [False] * 3


def test_information_errors_add_up_matrices_in_tasks(spark, lake):
    """By definition, from rows in several tasks; the rows are not scored by the model first."""
    at = {"intercepto": -2.0, "seg_high_risk": 1.5, "log_valor": 0.1}
    rows = model.feature_table(lake, True)
    x = np.array([[1.0, r.seg_high_risk, r.log_valor] for r in rows.collect()])
    p = 1 / (1 + np.exp(-x @ list(at.values())))
    wanted = np.sqrt(np.diag(np.linalg.inv((x * (p * (1 - p))[:, None]).T @ x)))
    got = model.information_errors(rows.repartition(5), at)
    assert list(got) == list(at) and list(got.values()) == pytest.approx(wanted.tolist(), rel=1e-9)


def test_the_glm_reads_its_rows_once(spark, lake, monkeypatch):
    """Assembled rows are held while its rounds pass over them, and let go afterwards."""
    held, fit = [], model.GeneralizedLinearRegression.fit
    monkeypatch.setattr(model.GeneralizedLinearRegression, "fit", lambda self, df: held.append((df, df.storageLevel.useMemory)) or fit(self, df))
    model.fit_glm(model.feature_table(lake, True))
    assert [kept for _, kept in held] == [True] and not held[0][0].storageLevel.useMemory
