"""The batch chain and the models: mechanics, sizes, persistence, selection.

The texts are invented, so quality figures mean nothing here.
"""

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from qirtas.operators import metrics, terms, vectors
from qirtas.operators import models as md
from qirtas.plans import batch
from qirtas.sources import fixtures
from qirtas.storage import fresh_path


@pytest.fixture(scope="module")
def chain(spark, small):
    raw = fixtures.labelled(spark, small)
    processed = batch.process(raw, fresh_path(spark, "processed"), fixtures.STOPWORDS)
    features = batch.write_features(
        processed, "doc_id", fresh_path(spark, "features"), fixtures.BATCH_LEXICON
    )
    return raw, processed, features, batch.write_training_rows(features, "doc_id")


@pytest.fixture(scope="module")
def fitted(chain):
    return {
        "Logistic Regression": batch.fit(md.logistic_regression, chain[3]),
        "Random Forest": batch.fit(md.random_forest, chain[3]),
    }


def test_chain_keeps_all_rows(chain):
    raw, processed, features, rows = chain
    assert raw.count() == processed.count() == features.count() == rows.count() == 87
    parts = {r["split"]: r["count"] for r in rows.groupBy("split").count().collect()}
    assert sum(parts.values()) == 87 and set(parts) == {"train", "val", "test"}


def test_vectors(chain):
    row = chain[3].first()
    assert row["features"].size == md.VECTOR_SIZE == 5004
    features = chain[2].first()
    assert features["rawFeatures"].size == features["tfidf_features"].size == 5000
    assert sum(features["rawFeatures"].values) == len(features["words"])
    labels = dict(chain[2].groupBy("label").agg(F.max("label_idx")).collect())
    assert labels == {"ai": 0.0, "human": 1.0}


def test_predictions_cover_the_test_part(chain, fitted):
    test = chain[3].filter("split = 'test'")
    for model in fitted.values():
        scored = model.transform(test)
        assert scored.count() == test.count()
        assert {r[0] for r in scored.select("prediction").distinct().collect()} <= {0.0, 1.0}


def test_refit_gives_the_same_model(chain, fitted):
    again = batch.fit(md.logistic_regression, chain[3])
    first = fitted["Logistic Regression"].coefficients.toArray()
    assert again.coefficients.toArray() == pytest.approx(first, abs=1e-6)


def test_hyperparameters(spark):
    lr, rf = md.logistic_regression(), md.random_forest()
    assert (lr.getMaxIter(), lr.getRegParam()) == (100, 0.01)
    assert (rf.getNumTrees(), rf.getSeed(), rf.getMaxDepth()) == (100, 42, 5)
    assert md.linear_svm().getMaxIter() == 100
    mlp = md.feed_forward()
    assert mlp.getLayers() == [5004, 256, 128, 2]
    assert (mlp.getMaxIter(), mlp.getSeed(), mlp.getBlockSize()) == (50, 42, 128)


def test_small_feed_forward_and_svm(chain):
    test = chain[3].filter("split = 'test'")
    for estimator in (lambda: md.feed_forward((5004, 4, 2)), md.linear_svm):
        scores = metrics.evaluate(batch.fit(estimator, chain[3]).transform(test))
        assert all(0.0 <= v <= 1.0 for v in scores.values())


def test_evaluation_equals_mllib(chain, fitted):
    for model in fitted.values():
        scored = model.transform(chain[3])
        scores = metrics.evaluate(scored)
        multi = MulticlassClassificationEvaluator(labelCol="label_idx", predictionCol="prediction")
        for own, name in [
            ("accuracy", "accuracy"),
            ("f1", "f1"),
            ("precision", "weightedPrecision"),
            ("recall", "weightedRecall"),
        ]:
            assert scores[own] == pytest.approx(multi.evaluate(scored, {multi.metricName: name}))


def test_importances(spark, fitted):
    model = fitted["Random Forest"]
    rows = md.top_importances(spark, model).collect()
    assert len(rows) == 5
    assert [r["importance"] for r in rows] == sorted((r["importance"] for r in rows), reverse=True)
    assert rows[0]["importance"] == pytest.approx(max(model.featureImportances.values))
    for row in rows:
        assert row["name"] == ("tfidf" if row["slot"] < 5000 else md.DENSE_NAMES[row["slot"] - 5000])


def test_save_overwrites_and_load_predicts_the_same(spark, chain, fitted):
    path = fresh_path(spark, "lr")
    for _ in range(2):
        md.save_model(fitted["Logistic Regression"], path)
    loaded = md.load_model(spark, path)
    test = chain[3].filter("split = 'test'")
    pick = ["doc_id", "prediction"]
    own = fitted["Logistic Regression"].transform(test).select(*pick).collect()
    assert sorted(loaded.transform(test).select(*pick).collect()) == sorted(own)


def test_best_model_and_selection_part(spark, chain, fitted):
    for part in ("test", "val"):
        best = batch.select_best(fitted, chain[3], fresh_path(spark, "best"), part).first()
        lines = md.compare(fitted, chain[3].filter(f"split = '{part}'")).collect()
        assert best["f1"] == max(r["f1"] for r in lines)
    tie = spark.createDataFrame(
        [("b", 0.1, 0.9, 0.2), ("a", 0.1, 0.9, 0.1)],
        "model string, accuracy double, f1 double, auc double",
    )
    assert md.best_model(tie).first()["model"] == "a"


def test_fit_on_train(spark, chain):
    rows = chain[2].select("cleaned_text", "label", "split")
    assert vectors.fit_tfidf(rows, "train").stages[2].numDocs < rows.count()


def test_models_score_after_term_counts(spark, chain, fitted):
    """Counting terms must leave nothing in the session that a model cannot be sent with."""
    models = [*fitted.values(), batch.fit(md.linear_svm, chain[3]), batch.fit(lambda: md.feed_forward((5004, 4, 2)), chain[3])]
    test = chain[3].filter("split = 'test'")
    terms.tfidf_terms(chain[2], "doc_id").count()
    for _ in range(3):
        for model in models:
            assert model.transform(test).agg(F.count("prediction")).first()[0] == test.count()


def test_load_any_class(spark, chain, fitted):
    path = fresh_path(spark, "rf")
    md.save_model(fitted["Random Forest"], path)
    assert type(md.load_model(spark, path)) is type(fitted["Random Forest"])
    spark.createDataFrame([('{"class": "org.example.Model"}',)], "value string").write.text(f"{path}-x/metadata")
    with pytest.raises(ValueError):
        md.load_model(spark, f"{path}-x")
