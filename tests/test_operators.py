"""Table operators: reshape, split, joins under skew, TF-IDF, metrics, sources."""

import json
import math
import random
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from qirtas import storage
from qirtas.operators import corpus, metrics, reshape, skew, terms, vectors
from qirtas.operators.split import assign_split
from qirtas.sources import messages, tables, wordlists


def test_unpivot_keeps_empty_and_drops_null(spark):
    wide = spark.createDataFrame(
        [("h1", "a1", None, "from_title"), ("", None, "o2", "by_polishing")],
        "original_abstract string, allam_generated_abstract string, "
        "openai_generated_abstract string, generation_method string",
    )
    rows = {tuple(r) for r in reshape.unpivot_sources(wide).collect()}
    assert rows == {
        ("h1", "human", "from_title", "human"),
        ("a1", "ai", "from_title", "allam"),
        ("", "human", "by_polishing", "human"),
        ("o2", "ai", "by_polishing", "openai"),
    }


def test_union_keeps_duplicates_and_fills_missing_columns(spark):
    a = spark.createDataFrame([("x", "y")], "original_abstract string, jais_generated_abstract string")
    b = spark.createDataFrame([("x",)], "original_abstract string")
    rows = reshape.union_splits({"from_title": a, "by_polishing": b}).collect()
    assert sorted((r[0], r[1], r[2]) for r in rows if r[1]) == [("x", "y", "from_title")]
    assert len(rows) == 2


def test_split_is_stable_under_repartitioning(spark):
    ids = spark.range(3000).withColumnRenamed("id", "k")
    one = {tuple(r) for r in assign_split(ids.coalesce(1), "k").collect()}
    many = {tuple(r) for r in assign_split(ids.repartition(7), "k").collect()}
    assert one == many
    shares = Counter(s for _, s in one)
    assert abs(shares["train"] / 3000 - 0.70) < 0.04
    assert abs(shares["val"] / 3000 - 0.15) < 0.03


def _skewed(rng, n):
    """A third of all tokens are one word; the tail is long."""
    return [
        rng.choices(["hot", f"w{rng.randint(0, 20)}", f"t{rng.randint(0, 4000)}"], [1, 1, 1])[0]
        for _ in range(n)
    ]


@pytest.mark.parametrize("hot_rows", [0, 1, 5, 50_000])
def test_tfidf_on_skewed_terms(spark, hot_rows):
    """The broadcast and the shuffled part together are the whole result."""
    rng = random.Random(5)
    docs = {i: _skewed(rng, rng.randint(0, 60)) for i in range(120)}
    docs[120] = ["z" * 400, "hot"]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "k int, cleaned_text string")
    got = {
        (r["k"], r["term"]): (r["tf"], r["df"], r["tfidf"])
        for r in terms.tfidf_terms(df, "k", hot_rows=hot_rows).collect()
    }
    frequency = Counter(w for words in docs.values() for w in set(words))
    expected = {(i, w): c for i, words in docs.items() for w, c in Counter(words).items()}
    assert got.keys() == expected.keys()
    for (i, w), tf in expected.items():
        idf = math.log((len(docs) + 1) / (frequency[w] + 1))
        assert got[i, w] == (tf, frequency[w], pytest.approx(tf * idf))


def test_tfidf_terms_equal_mllib(spark):
    """The token-level weights, summed per document, equal MLlib's hashed ones."""
    rng = random.Random(9)
    df = spark.createDataFrame(
        [
            (i, " ".join(f"w{rng.randint(0, 40)}" for _ in range(30)), "ai" if i % 4 else "human")
            for i in range(60)
        ],
        "k int, cleaned_text string, label string",
    )
    # Wide enough that no two of the terms share a bucket.
    model = vectors.fit_tfidf(df, size=1 << 18)
    hashed = {
        r["k"]: sum(r["tfidf_features"].values) for r in model.transform(df).collect()
    }
    own = terms.tfidf_terms(df, "k").groupBy("k").agg(F.sum("tfidf").alias("s")).collect()
    for row in own:
        assert row["s"] == pytest.approx(hashed[row["k"]], rel=1e-6)


def test_label_index_equals_mllib(spark):
    rows = [("b",), ("b",), ("a",), ("a",), ("c",), ("c",), ("c",), ("d",)]
    df = spark.createDataFrame(rows, "label string").withColumn("cleaned_text", F.lit("ا"))
    fitted = vectors.fit_tfidf(df).transform(df).select("label", "label_idx").distinct().collect()
    own = terms.label_index(df).select("label", "label_idx").collect()
    assert sorted(own) == sorted(fitted)
    assert dict(own) == {"c": 0.0, "a": 1.0, "b": 2.0, "d": 3.0}


def test_fit_on_train_ignores_other_parts(spark):
    df = spark.createDataFrame(
        [("ا ب", "ai", "train"), ("ا", "human", "train"), ("ج", "human", "test")],
        "cleaned_text string, label string, split string",
    )
    assert vectors.fit_tfidf(df).stages[2].numDocs == 3
    assert vectors.fit_tfidf(df, fit_on="train").stages[2].numDocs == 2
    with pytest.raises(ValueError):
        vectors.fit_tfidf(df, fit_on="test")


def test_running_totals(spark):
    values = [(i, (i * 7) % 11) for i in range(500)]
    df = spark.createDataFrame(values, "k int, v long").repartition(5)
    before, expected = 0, {}
    for k, v in values:
        expected[k] = before
        before += v
    got = {r["k"]: r["v_before"] for r in skew.running_totals(df, "k", ["v"]).collect()}
    assert got == expected


def _scored(spark, n=400, hot=True):
    """Scores with many ties; a third of all rows share one score."""
    rng = random.Random(11)
    rows = []
    for i in range(n):
        actual = float(rng.random() < 0.3)
        score = 0.5 if hot and i % 3 == 0 else round(rng.gauss(actual, 1.0), 1) + 0.0
        rows.append((i, actual, float(score > 0.5), score))
    return spark.createDataFrame(rows, "k int, label_idx double, prediction double, score double")


def test_metric_twins_equal_mllib(spark):
    df = _scored(spark).withColumn(
        "rawPrediction", array_to_vector(F.array(-F.col("score"), F.col("score")))
    )
    own = metrics.class_metrics(df, "label_idx").first()
    multi = MulticlassClassificationEvaluator(labelCol="label_idx", predictionCol="prediction")
    for column, name in [
        ("accuracy", "accuracy"),
        ("weighted_f1", "f1"),
        ("weighted_precision", "weightedPrecision"),
        ("weighted_recall", "weightedRecall"),
    ]:
        assert own[column] == pytest.approx(multi.evaluate(df, {multi.metricName: name}))
    positive = df.withColumn("positive", F.col("label_idx") == 1.0)
    auc = metrics.area_under_roc(positive, "score", "positive").first()["auc"]
    exact = BinaryClassificationEvaluator(labelCol="label_idx", numBins=0)
    assert auc == pytest.approx(exact.evaluate(df))
    scores = metrics.evaluate(df)
    assert set(scores) == {"accuracy", "f1", "precision", "recall", "auc"}


def test_metrics_of_one_class(spark):
    df = spark.createDataFrame([("a", "a", 1.0, True)] * 3, "label string, prediction string, s double, p boolean")
    assert tuple(metrics.class_metrics(df).first()) == (3, 1.0, 1.0, 1.0, 1.0)
    assert metrics.area_under_roc(df, "s", "p").first()["auc"] is None


def test_confusion_matrix(spark):
    df = spark.createDataFrame(
        [("ai", "ai"), ("ai", "human"), ("human", "ai"), ("ai", "ai"), ("ai", None), ("ai", "new")],
        "label string, prediction string",
    )
    rows = metrics.confusion_matrix(df, ["ai", "human"]).collect()
    assert {tuple(r) for r in rows} == {("ai", 2, 1, 2), ("human", 1, 0, 0)}


def test_corpus_ties_and_empty_texts(spark):
    df = spark.createDataFrame(
        [("ب ا", "x"), ("ا ب", "x"), ("", "y"), ("ج", "y")], "cleaned_text string, label string"
    )
    assert [tuple(r) for r in corpus.top_words(df, k=2).collect()] == [("ا", 2), ("ب", 2)]
    assert [tuple(r) for r in corpus.top_bigrams(df).collect()] == [("ا ب", 1), ("ب ا", 1)]
    assert dict(corpus.avg_words(df).collect()) == {"x": 2.0, "y": 1.0}
    assert dict(corpus.ttr_by_label(df).collect()) == {"x": 1.0, "y": 0.5}


def test_null_profile(spark):
    df = spark.createDataFrame([(None, ""), ("a", None), (None, "b")], "x string, y string")
    assert tuple(corpus.null_profile(df).first()) == (2, 1)


def test_word_list(spark, tmp_path):
    (tmp_path / "words.txt").write_text("\nفي\nمن  على\tفي\n\nإلى\n", encoding="utf-8")
    words = wordlists.load_words(spark, str(tmp_path / "words.txt"))
    assert wordlists.literal_words(words) == {"في", "من", "على", "إلى"}
    assert wordlists.literal_words(words, limit=3) is None


def test_long_word_list_is_joined(spark):
    """Beyond the literal limit the join gives the same tokens in the same order."""
    df = spark.createDataFrame(
        [(1, "ا ب ا ج", "x"), (1, "ب ا", None), (1, "ب ا", None), (2, "ب ب", "y"), (3, "د ا د", "z"), (4, "ج", "")], "k int, cleaned_text string, other string"
    )
    words = spark.createDataFrame([("ب",), ("د",)], "word string")
    literal = wordlists.drop_words(df, "cleaned_text", words)
    assert sorted(map(str, map(tuple, literal.collect()))) == sorted(map(str, [(1, "ا ا ج", "x"), (1, "ا", None), (1, "ا", None), (3, "ا", "z"), (4, "ج", "")]))
    for hot_rows in (0, 1, 100):
        joined = wordlists.drop_words(df, "cleaned_text", words, limit=1, hot_rows=hot_rows)
        assert sorted(map(str, joined.collect())) == sorted(map(str, literal.collect()))


def test_messages_roundtrip(spark):
    rows = [(1, 'ق"و\\ل\n', "ai"), (2, None, "human"), (3, "x" * 600, None)]
    df = spark.createDataFrame(rows, "k long, text string, label string")
    encoded = df.select(
        "k", messages.encode(F.col("text"), F.col("label"), F.col("k")).alias("value")
    )
    for k, value in encoded.collect():
        _, body, label = rows[k - 1]
        assert json.loads(value) == {"text": body and body[:500], "label": label, "id": k}
    assert 'ق' in encoded.filter("k = 1").first()["value"]
    back = messages.decode(encoded.withColumn("value", F.col("value").cast("binary")), ("k",))
    for k, body, label, id_ in back.collect():
        assert (body, label, id_) == (rows[k - 1][1] and rows[k - 1][1][:500], rows[k - 1][2], k)


def test_malformed_messages_give_nulls(spark):
    bad = ['{"text": "ا', "", "<html>", '{"text": "ا", "label": "ai", "id": "x"}', None]
    df = spark.createDataFrame(list(enumerate(bad)), "k int, value string")
    rows = {r[0]: tuple(r)[1:] for r in messages.decode(df, ("k",)).collect()}
    assert rows[3] == ("ا", "ai", None)
    assert all(rows[k] == (None, None, None) for k in (0, 1, 2, 4))


def test_sample_is_reproducible_and_numbered(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    one = [tuple(r) for r in messages.numbered_sample(df.repartition(6), "k", 50).collect()]
    two = [tuple(r) for r in messages.numbered_sample(df.coalesce(1), "k", 50).collect()]
    assert sorted(one) == sorted(two)
    assert sorted(i for _, i in one) == list(range(50))


def test_sinks_overwrite_and_prune(spark, tmp_path):
    path = str(tmp_path / "t")
    df = assign_split(spark.range(200).withColumnRenamed("id", "k"), "k")
    for _ in range(2):
        tables.write_table(df, path, ("split",))
    back = tables.read_table(spark, path)
    assert back.count() == 200
    plan = back.filter("split = 'test'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_written_tables_go_to_the_shared_folder(spark):
    df = storage.materialize(spark.range(5), "five")
    assert df.count() == 5
    assert storage.shared_folder(spark) in df.inputFiles()[0]


def test_no_temporary_folder_on_a_cluster():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(RuntimeError):
        storage.shared_folder(Session())


@pytest.mark.parametrize("folder, default, refused", [("/tmp/x", "file:///", True), ("file:/tmp/x", "hdfs://n/", True), ("/x", "hdfs://n/", False), ("s3a://b/x", "file:///", False)])
def test_folders_of_one_machine_are_refused_on_a_cluster(folder, default, refused):
    hadoop = SimpleNamespace(get=lambda name, other: default)
    context = SimpleNamespace(master="yarn", _jsc=SimpleNamespace(hadoopConfiguration=lambda: hadoop))
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda name, other: folder))
    if refused:
        with pytest.raises(RuntimeError):
            storage.shared_folder(session)
    else:
        assert storage.shared_folder(session) == folder


def test_configured_folder_wins():
    class Session:
        sparkContext = SimpleNamespace(master="yarn")

        class conf:
            @staticmethod
            def get(name, default):
                return {"spark.checkpoint.dir": "hdfs:///shared/"}[name]

    assert storage.shared_folder(Session()) == "hdfs:///shared"
