"""Hashed vectors by value, models by their parameters, grouped figures, numbering: against plain Python and MLlib."""

import hashlib
import random
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from qirtas.functions.hashing import with_term_slot
from qirtas.operators import forest, hashed, linear, metrics, network, skew
from qirtas.storage import materialize


def test_term_slots_equal_mllib(spark):
    rng = random.Random(4)
    words = ["".join(rng.choices("abéأبة漢𝒳", k=rng.randint(0, 9))) for _ in range(500)]
    df = spark.createDataFrame([(w, [w]) for w in words], "term string, words array<string>")
    rows = HashingTF(inputCol="words", outputCol="v", numFeatures=5000).transform(with_term_slot(df, "term", 5000))
    assert all(int(r["v"].indices[0]) == r["slot"] for r in rows.collect())


def test_vector_words_equal_the_tokenizer(spark):
    texts = ["", " ", "a", " a", "a ", "A  b\t c\n", "\n\n", "ا ب", "a\x0bb", "x  y"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = Tokenizer(inputCol="t", outputCol="words").transform(df).select("t", "words", hashed.vector_words("t").alias("own"))
    assert all(r["words"] == r["own"] for r in rows.collect())


def test_tfidf_slots_edges(spark):
    """Two rows with one key stay two; a null text and one without words count among the documents only."""
    rows = [(1, "ا ب ا"), (1, "ب"), (2, ""), (3, None), (None, "ا")]
    df = materialize(spark.createDataFrame(rows, "k int, t string"), "texts")
    got = hashed.tfidf_slots(df, "k", hashed.vector_words("t"), 5000).collect()
    slot = {r["term"]: r["slot"] for r in with_term_slot(spark.createDataFrame([("ا",), ("ب",), ("",)], "term string"), "term", 5000).collect()}
    two, one = np.log(6 / 3), np.log(6 / 2)
    want = [(1, slot["ا"], 2, 2, 2 * two), (1, slot["ب"], 1, 2, two), (1, slot["ب"], 1, 2, two), (2, slot[""], 1, 1, one), (None, slot["ا"], 1, 2, two)]
    assert len(set(slot.values())) == 3
    assert sorted(map(str, [(*r[:4], round(r[4], 9)) for r in got])) == sorted(map(str, [(*w[:4], round(float(w[4]), 9)) for w in want]))
    assert hashed.tfidf_slots(df.limit(0), "k", hashed.vector_words("t")).count() == 0


def _long(spark, x):
    rows = [(i, j, float(v)) for i, row in enumerate(x) for j, v in enumerate(row) if v]
    return materialize(spark.createDataFrame(rows, "k int, slot int, value double"), "long")


def _labels(spark, y):
    return materialize(spark.createDataFrame([(i, float(v)) for i, v in enumerate(y)], "k int, label_idx double"), "labels")


def _model(weights, intercept):
    w = np.array(weights, float)
    return SimpleNamespace(coefficients=SimpleNamespace(size=len(w), toArray=lambda: w), intercept=intercept)


def test_margins_of_rows_without_values(spark):
    x = np.array([[1.0, 0, 2], [0, 0, 0], [0, -3, 0]])
    got = linear.margins(_long(spark, x), _labels(spark, [0, 1, 1]), "k", _model([1, 2, 4], 0.5)).collect()
    assert {r["k"]: r["margin"] for r in got} == {0: 9.5, 1: 0.5, 2: -5.5}


def test_logistic_gradient(spark):
    """Equals the differences of the plain loss, at any weights; the constant slot has no say."""
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.normal(size=40), rng.integers(0, 3, 40), np.full(40, 2.0), np.zeros(40)])
    y = (rng.random(40) < 0.4).astype(float)
    w, b, penalty = np.array([0.3, -0.7, 0.2, 0.1]), 0.1, 0.05
    deviation = x.std(0, ddof=1)

    def loss(scaled, b):
        w = np.where(deviation > 0, scaled / np.where(deviation > 0, deviation, 1), 0.2)
        m = x @ w + b
        return np.mean(np.log1p(np.exp(m)) - y * m) + penalty / 2 * np.sum(scaled[deviation > 0] ** 2)

    scaled = w * deviation
    rows = linear.logistic_gradient(_long(spark, x), _labels(spark, y), "k", _model(w, b), penalty).collect()
    got = {r["slot"]: r["gradient"] for r in rows}
    assert set(got) == {-1, 0, 1, 2, 3} and got[2] == got[3] == 0
    step = 1e-6
    for j in (0, 1):
        e = np.eye(4)[j] * step
        assert got[j] == pytest.approx((loss(scaled + e, b) - loss(scaled - e, b)) / (2 * step), abs=1e-6)
    assert got[-1] == pytest.approx((loss(scaled, b + step) - loss(scaled, b - step)) / (2 * step), abs=1e-6)


def test_hinge_slopes(spark):
    """One-sided differences of the plain loss; rows on the edge count on both sides; a minimum has none below zero."""
    x = np.array([[1.0, 2], [-1, 0], [0.5, -1], [-2, 0.5], [1, 1], [0, 0]])
    y = np.array([1.0, 0, 0, 1, 1, 0])
    deviation = x.std(0, ddof=1)

    def loss(w, b):
        return np.mean(np.maximum(0, 1 - (2 * y - 1) * (x @ w + b)))

    def slopes(w, b):
        rows = linear.hinge_slopes(_long(spark, x), _labels(spark, y), "k", _model(w, b)).collect()
        return {r["slot"]: (r["up"], r["down"]) for r in rows}

    step = 1e-4
    for w, b in (([0.0, 0.0], -1.0), ([1.0, 0.0], 0.0), ([0.25, 0.5], 0.25), ([0.3, -0.2], 0.7)):
        w = np.array(w)
        for j, (up, down) in slopes(w, b).items():
            move = (np.eye(2)[j] * step, 0) if j >= 0 else (np.zeros(2), step)
            unit = deviation[j] if j >= 0 else 1
            assert up == pytest.approx((loss(w + move[0], b + move[1]) - loss(w, b)) / step / unit, abs=1e-6)
            assert down == pytest.approx((loss(w - move[0], b - move[1]) - loss(w, b)) / step / unit, abs=1e-6)
    x, y = np.array([[1.0, 0], [2, 1], [-1, 0], [-2, 3]]), np.array([1.0, 1, 0, 0])
    deviation = x.std(0, ddof=1)
    least = slopes(np.array([1.0, 0.0]), 0.0)
    assert min(min(v) for v in least.values()) >= 0 and least[0][1] > 0
    assert min(min(v) for v in slopes(np.array([0.9, 0.0]), 0.0).values()) < -0.1


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(120, 5)) * (rng.random((120, 5)) < 0.6), 2)
    y = ((x[:, 0] + x[:, 1] * x[:, 2] > 0) ^ (rng.random(120) < 0.1)).astype(float)
    dense = [(i, [float(v) for v in row], float(t)) for i, (row, t) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(dense, "k int, a array<double>, label_idx double")
    return _long(spark, x), _labels(spark, y), materialize(df.withColumn("features", array_to_vector("a")), "cloud")


@pytest.mark.parametrize("trees,depth", [(1, 0), (7, 4)])
def test_forest_votes_and_importances(spark, cloud, trees, depth):
    values, labels, df = cloud
    model = RandomForestClassifier(labelCol="label_idx", numTrees=trees, maxDepth=depth, seed=1).fit(df)
    nodes = forest.node_table(model, df)
    own = {r["k"]: r["votes"] for r in forest.votes(values, labels, "k", nodes, depth).collect()}
    said = {r["k"]: r[1] for r in model.transform(df).select("k", vector_to_array("rawPrediction")).collect()}
    assert own.keys() == said.keys()
    assert all(own[k] == pytest.approx(said[k]) for k in said)
    weights = dict(forest.importances(nodes).collect())
    whole = model.featureImportances.toArray()
    assert [weights.get(i, 0.0) for i in range(len(whole))] == pytest.approx(list(whole))


def test_network_products(spark, cloud):
    values, labels, df = cloud
    model = MultilayerPerceptronClassifier(labelCol="label_idx", layers=[5, 4, 3, 2], maxIter=5, seed=1).fit(df)
    vectors = hashed.sparse_vectors(values, "k", "value")
    said = {r["k"]: r[1] for r in model.transform(df).select("k", vector_to_array("probability")).collect()}
    own = {r["k"]: r["probabilities"] for r in network.probabilities(vectors, "k", model).collect()}
    assert own and all(own[k] == pytest.approx(said[k]) for k in own)


def test_running_totals_by_group(spark):
    rng = random.Random(3)
    rows = [(g, i, rng.randint(0, 9)) for g, n in (("a", 300), ("b", 5), ("c", 1)) for i in range(n)]
    want = {(g, i): sum(v for h, j, v in rows if h == g and j < i) for g, i, _ in rows}
    df = spark.createDataFrame(rows, "g string, k int, v long").repartition(5)
    got = skew.running_totals(df, "k", ["v"], by="g").collect()
    assert {(r["g"], r["k"]): r["v_before"] for r in got} == want


def test_evaluation_of_groups_is_that_of_each(spark):
    rng = random.Random(5)
    rows = [(m, float(rng.random() < 0.4), float(rng.random() < 0.5), round(rng.random(), 1)) for m in "xyz" for _ in range(90)]
    rows += [("one class", 0.0, 0.0, 0.3)] * 4
    df = spark.createDataFrame(rows, "model string, label_idx double, prediction double, score double")
    together = {r["model"]: r.asDict() for r in metrics.evaluation(df).collect()}
    assert together["one class"]["auc"] is None and together["one class"]["n"] == 4
    for m in "xyz":
        own = df.filter(F.col("model") == m)
        alone = metrics.class_metrics(own, "label_idx").first()
        area = metrics.area_under_roc(own.withColumn("p", F.col("label_idx") == 1), "score", "p").first()["auc"]
        line = together[m]
        assert (line["accuracy"], line["f1"], line["auc"]) == pytest.approx((alone["accuracy"], alone["weighted_f1"], area))
    matrix = metrics.confusion_matrix(df, [0.0, 1.0], "label_idx", by=("model",)).collect()
    assert sum(sum(r[2:]) for r in matrix) == len(rows) and len(matrix) == 7


@pytest.mark.parametrize("n", [0, 1, 50, 400, 10_000])
def test_first_in_order(spark, n):
    keys = [*range(390), None, 7, 7, 7, *range(1000, 1010)]
    df = spark.createDataFrame([(k,) for k in keys], "k int").repartition(6)
    digest = lambda k: hashlib.md5(str(k).encode()).hexdigest()
    order = sorted(keys, key=lambda k: (k is not None, digest(k), k or 0))[:n]
    got = skew.first_in_order(df, "k", n).collect()
    assert [r["k"] for r in sorted(got, key=lambda r: r["id"])] == order
    assert sorted(r["id"] for r in got) == list(range(len(order)))


def test_numbering_sorts_in_no_single_task(spark):
    frame = skew.first_in_order(spark.range(5000).withColumnRenamed("id", "k"), "k", 3000)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan
    # The one window sees a row for each range; the numbered rows are only joined to it.
    assert plan.count("Window") <= 2 and plan.index("BroadcastHashJoin") < plan.index("Window")
