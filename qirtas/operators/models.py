"""Classifiers, feature importances, comparison and persistence."""

from __future__ import annotations

import importlib
import json
from functools import reduce

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.operators.metrics import evaluation
from qirtas.operators.vectors import DENSE_FEATURES, NUM_FEATURES
from qirtas.storage import materialize

_COLUMNS = {"featuresCol": "features", "labelCol": "label_idx"}
VECTOR_SIZE = NUM_FEATURES + len(DENSE_FEATURES)


# The hyperparameters of the four models.
def logistic_regression() -> Estimator:
    return LogisticRegression(**_COLUMNS, maxIter=100, regParam=0.01)


def random_forest() -> Estimator:
    return RandomForestClassifier(**_COLUMNS, numTrees=100, seed=42)


def linear_svm() -> Estimator:
    return LinearSVC(**_COLUMNS, maxIter=100)


def feed_forward(layers: tuple[int, ...] = (VECTOR_SIZE, 256, 128, 2)) -> Estimator:
    return MultilayerPerceptronClassifier(
        **_COLUMNS, layers=list(layers), maxIter=50, seed=42, blockSize=128
    )


# The three models that are compared with each other, by display name.
COMPARED = {
    "Logistic Regression": logistic_regression,
    "Random Forest": random_forest,
    "Linear SVM": linear_svm,
}

LINEAR = (LogisticRegression, LinearSVC)

# Fitted, evaluated and saved beside them, but not chosen from.
NETWORK = "Feed Forward"

# Names of the dense slots in the importance report.
DENSE_NAMES = ["f15_word_len_var", "f36_avg_s_p", "f57_top50", "f78_perplexity"]


def top_importances(
    spark: SparkSession, model: RandomForestClassificationModel, k: int = 5
) -> DataFrame:
    """slot, name, importance of the k most important slots; hashed slots are ``tfidf``."""
    weights = model.featureImportances
    hashed = weights.size - len(DENSE_NAMES)
    slots = [(int(i), float(v)) for i, v in zip(weights.indices, weights.values)]
    slot = F.col("slot")
    name = F.when(slot < hashed, "tfidf").otherwise(
        F.get(F.array(*[F.lit(n) for n in DENSE_NAMES]), (slot - hashed).cast("int"))
    )
    return (
        spark.createDataFrame(slots, "slot int, importance double")
        .select("slot", name.alias("name"), "importance")
        .orderBy(F.desc("importance"), "slot")
        .limit(k)
    )


def scored_rows(models: dict[str, Model], rows: DataFrame, key: str | None = None) -> DataFrame:
    """The long table (model, key, label_idx, prediction, score): every row by every model; written once."""
    score = vector_to_array("rawPrediction")[1].alias("score")
    kept = [key] if key else []
    parts = [
        model.transform(rows).select(F.lit(name).alias("model"), *kept, "label_idx", "prediction", score)
        for name, model in models.items()
    ]
    return materialize(reduce(DataFrame.unionByName, parts), "scored")


def compare(models: dict[str, Model], rows: DataFrame) -> DataFrame:
    """model, n, accuracy, f1, precision, recall, auc on ``rows``: one line per model, in one plan."""
    return evaluation(scored_rows(models, rows))


def best_model(comparison: DataFrame) -> DataFrame:
    """The line with the highest weighted F1; ties go to the first name."""
    return comparison.orderBy(F.desc("f1"), "model").limit(1)


def save_model(model: Model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> Model:
    """A saved model of any class of MLlib; the class is the one in its metadata.

    A loaded model has no training summary, so its scoring closure drags neither
    a session nor a training table along.
    """
    name = json.loads(spark.read.text(f"{path}/metadata").first()["value"])["class"]
    if not name.startswith("org.apache.spark.ml."):
        raise ValueError(f"{path} holds no model of MLlib but {name}")
    module, kind = name.replace("org.apache.spark", "pyspark").rsplit(".", 1)
    return getattr(importlib.import_module(module), kind).load(path)
