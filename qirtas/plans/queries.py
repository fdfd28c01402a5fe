"""Every registered query: (session, table folder) -> DataFrame, over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.ml import Model
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.functions import rules, style, text, tokens
from qirtas.operators import corpus, forest, hashed, linear, metrics, network, reshape, terms, vectors
from qirtas.operators import models as md
from qirtas.operators.features import with_cleaned, with_features
from qirtas.operators.split import assign_split, split_bucket
from qirtas.plans import batch
from qirtas.sources import fixtures, messages, tables, wordlists
from qirtas.storage import fresh_path, is_written, materialize
from qirtas.streaming import scoring

Query = Callable[[SparkSession, str], DataFrame]
TABLES = ["documents", "labels", "conversations", "pages", "benchmark"]
CLASSES = ["ai", "human", "unknown"]


# Shared inputs ---------------------------------------------------------------
def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.documents(spark, sf)


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.labelled(spark, sf)


def _sources(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).withColumnRenamed("source", "source_model")


def prepare(spark: SparkSession, sf: str) -> None:
    """Write the derived input tables ahead of the queries."""
    _docs(spark, sf)
    _labelled(spark, sf)


def _cleaned(df: DataFrame, stopwords: Iterable[str] = ()) -> DataFrame:
    return with_cleaned(df, stopwords=stopwords)


def _features(df: DataFrame) -> DataFrame:
    return with_features(_cleaned(df), lexicon=fixtures.BATCH_LEXICON)


def _raw_long(spark: SparkSession, sf: str) -> DataFrame:
    wide = fixtures.wide_abstracts(spark, sf)
    return reshape.unpivot_sources(wide, ("conv_id", "part", "generation_method"))


def _per_document(expression: Callable[[], dict[str, Column]]) -> Query:
    """A query that maps one expression over every transliterated document."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        return _docs(spark, sf).select("doc_id", *[c.alias(n) for n, c in expression().items()])

    return query


def _exact(column: str) -> Column:
    return F.round(F.col(column).cast("double"), 6).alias(column)


# Sources and sinks -----------------------------------------------------------
def scan_profile(spark: SparkSession, sf: str) -> DataFrame:
    return tables.scan_profile(
        {name: tables.read_table(spark, f"{sf}/{name}.parquet") for name in TABLES}
    )


def stopword_vocab(spark: SparkSession, sf: str) -> DataFrame:
    """The word-list loader on a text file made of all cleaned documents."""
    path = fresh_path(spark, "words")
    _cleaned(_docs(spark, sf)).select("cleaned_text").write.text(path)
    return wordlists.load_words(spark, path)


def processed_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    written = batch.process(
        _labelled(spark, sf), fresh_path(spark, "processed"), fixtures.STOPWORDS, stem=False
    )
    return written.select("doc_id", "label", "source_model", "generation_method", "cleaned_text")


def split_sinks(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "splits")
    tables.write_table(assign_split(_docs(spark, sf), "doc_id"), path, ("split",))
    return (
        tables.read_table(spark, path)
        .groupBy(F.col("split").cast("string").alias("split"))
        .agg(F.count("*").alias("n"), F.sum("doc_id").alias("sum_doc_id"))
    )


def raw_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "raw")
    tables.write_table(_raw_long(spark, sf).drop("conv_id", "part"), path)
    return (
        tables.read_table(spark, path)
        .groupBy("label", "generation_method", "source_model")
        .agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))
    )


def encode_messages(spark: SparkSession, sf: str) -> DataFrame:
    """The sampled messages, as the encoder sends them: 100 rows, 500 characters."""
    sample = messages.numbered_sample(_labelled(spark, sf), "doc_id")
    value = messages.encode(F.col("text"), F.col("label"), F.col("id"))
    return sample.select(value.alias("value"))


def encode_all_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Every document, whole text."""
    value = messages.encode(F.col("text"), F.col("label"), F.col("doc_id"), max_chars=None)
    return fixtures.all_documents(spark, sf).select("doc_id", value.alias("value"))


def decode_messages(spark: SparkSession, sf: str) -> DataFrame:
    return messages.decode(fixtures.messages(spark, sf), keep=("source_id",)).withColumn(
        "id", F.col("id").cast("long")
    )


# Reshape ---------------------------------------------------------------------
def unpivot_sources(spark: SparkSession, sf: str) -> DataFrame:
    return _raw_long(spark, sf)


def union_splits(spark: SparkSession, sf: str) -> DataFrame:
    wide = fixtures.wide_abstracts(spark, sf)
    parts = {
        m: wide.filter(F.col("generation_method") == m).drop("generation_method")
        for m in reshape.METHODS
    }
    return reshape.union_splits(parts)


def source_counts_raw(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.value_counts(_raw_long(spark, sf), "source_model")


# Filters and samples ---------------------------------------------------------
def nonempty_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every document in its Latin and its Arabic form; the empty cleaned ones go."""
    latin = spark.read.parquet(f"{sf}/documents.parquet").select(
        "doc_id", F.lit("latin").alias("script"), "text"
    )
    arabic = _docs(spark, sf).select("doc_id", F.lit("arabic").alias("script"), "text")
    return _cleaned(latin.unionByName(arabic)).groupBy("script").agg(
        F.count("*").alias("n"), F.sum("doc_id").alias("sum_doc_id")
    )


def sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    return messages.numbered_sample(_docs(spark, sf), "doc_id").select(
        F.col("id").cast("long").alias("id"), "doc_id", "source"
    )


# Scalar text functions -------------------------------------------------------
def _tokenize() -> dict[str, Column]:
    toks = tokens.tokenize(text.script_filter("text"))
    return {
        "joined": F.array_join(toks, "|"),
        "n_tokens": F.size(toks).cast("long"),
    }


def remove_stopwords(spark: SparkSession, sf: str) -> DataFrame:
    return _cleaned(_docs(spark, sf), fixtures.STOPWORDS).select("doc_id", "cleaned_text")


def drop_words_long(spark: SparkSession, sf: str) -> DataFrame:
    """The same words over all documents, looked up by joins as a long list is."""
    words = spark.createDataFrame([(w,) for w in fixtures.STOPWORDS], "word string")
    cleaned = _cleaned(_docs(spark, sf)).select("doc_id", "cleaned_text")
    return wordlists.drop_words(cleaned, "cleaned_text", words, limit=0)


def remove_stopwords_folded(spark: SparkSession, sf: str) -> DataFrame:
    """The same list folded first, so that none of its words is dead."""
    folded = text.fold_words(fixtures.STOPWORDS)
    return _cleaned(_docs(spark, sf), folded).select("doc_id", "cleaned_text")


def stem_vocab(spark: SparkSession, sf: str) -> DataFrame:
    return terms.stem_vocabulary(_cleaned(_docs(spark, sf)))


def clean_text_stemmed(spark: SparkSession, sf: str) -> DataFrame:
    df = with_cleaned(_docs(spark, sf), stopwords=fixtures.STOPWORDS, stem=True)
    return df.select("doc_id", "cleaned_text")


def bigram_rows(spark: SparkSession, sf: str) -> DataFrame:
    return (
        _cleaned(_docs(spark, sf))
        .select("doc_id", F.posexplode(tokens.bigrams(tokens.tokenize("cleaned_text"))))
        .select(
            "doc_id",
            F.col("pos").cast("long").alias("pos"),
            F.concat_ws(" ", "col.first", "col.second").alias("bigram"),
        )
    )


# Corpus statistics -----------------------------------------------------------
def label_counts(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.value_counts(_labelled(spark, sf), "label")


def source_counts(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.value_counts(_sources(spark, sf), "source_model")


def length_stats(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.length_stats(_labelled(spark, sf))


def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.null_profile(fixtures.wide_abstracts(spark, sf))


def ttr_by_label(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.ttr_by_label(_cleaned(_labelled(spark, sf)))


def clean_stats(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.clean_stats(_cleaned(_labelled(spark, sf)))


def avg_words(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.avg_words(_cleaned(_labelled(spark, sf))).withColumn(
        "avg_words", F.round("avg_words", 6)
    )


def word_count_top(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.top_words(_cleaned(_docs(spark, sf)))


def bigram_top(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.top_bigrams(_cleaned(_docs(spark, sf)))


def feature_means(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.feature_means(_features(_labelled(spark, sf)))


# Stylometric features --------------------------------------------------------
def _feature(name: str, expression: Callable[[], Column]) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        df = _cleaned(_docs(spark, sf)).withColumn("tokens", tokens.tokenize("cleaned_text"))
        return df.select("doc_id", expression().alias(name)).select("doc_id", _exact(name))

    return query


def f57(spark: SparkSession, sf: str) -> DataFrame:
    """Hits of the fixture lexicon and of the built-in one."""
    toks = F.col("tokens")
    df = _cleaned(_docs(spark, sf)).withColumn("tokens", tokens.tokenize("cleaned_text"))
    return df.select(
        "doc_id",
        style.lexicon_hits(toks, fixtures.BATCH_LEXICON).cast("long").alias("hits"),
        style.lexicon_hits(toks).cast("long").alias("hits_built_in"),
    )


def features(spark: SparkSession, sf: str) -> DataFrame:
    return _features(_docs(spark, sf)).select(
        "doc_id",
        _exact("f15_word_len_variance"),
        _exact("f36_avg_sent_per_para"),
        F.col("f57_top50_words_count").cast("long").alias("f57_top50_words_count"),
        _exact("f78_perplexity"),
    )


# Vectors, index, split -------------------------------------------------------
def tfidf_terms(spark: SparkSession, sf: str) -> DataFrame:
    scored = terms.tfidf_terms(_cleaned(_docs(spark, sf)), "doc_id")
    return scored.select("doc_id", "term", "tf", "df", _exact("idf"), _exact("tfidf"))


def label_index(spark: SparkSession, sf: str) -> DataFrame:
    return terms.label_index(_labelled(spark, sf))


def source_index(spark: SparkSession, sf: str) -> DataFrame:
    return terms.label_index(_sources(spark, sf), "source_model")


def hashed_tf(spark: SparkSession, sf: str) -> DataFrame:
    df = vectors.hashed_tf(_cleaned(_docs(spark, sf)).select("doc_id", "cleaned_text"))
    counts = vector_to_array("rawFeatures")
    mass = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return df.select(
        "doc_id",
        F.size(counts).cast("long").alias("vector_size"),
        mass.cast("long").alias("n_tokens"),
    )


def tfidf_slots(spark: SparkSession, sf: str) -> DataFrame:
    """Hashed TF-IDF by value: every slot of every document."""
    cleaned = materialize(_cleaned(_docs(spark, sf)).select("doc_id", "cleaned_text"), "cleaned")
    slots = hashed.tfidf_slots(cleaned, "doc_id", hashed.vector_words("cleaned_text"))
    return slots.select("doc_id", "slot", "tf", "df", _exact("weight"))


_paths: dict[tuple[str, str, str], str] = {}


def _kept(spark: SparkSession, key: tuple[str, str, str]) -> bool:
    return key in _paths and is_written(spark, _paths[key])


def _feature_table(spark: SparkSession, sf: str) -> DataFrame:
    """Features, vectors and split of the labelled documents, written once."""
    key = (spark.sparkContext.applicationId, sf, "features")
    if not _kept(spark, key):
        processed = batch.process(
            _labelled(spark, sf), fresh_path(spark, "processed"), fixtures.STOPWORDS
        )
        path = fresh_path(spark, "features")
        batch.write_features(processed, "doc_id", path, fixtures.BATCH_LEXICON)
        _paths[key] = path
    return tables.read_table(spark, _paths[key])


def tfidf_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return _feature_table(spark, sf).select(
        "doc_id",
        "label",
        "label_idx",
        F.size("words").cast("long").alias("n_words"),
        F.size(vector_to_array("tfidf_features")).cast("long").alias("vector_size"),
    )


def _close(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= 1e-9 * (1 + F.abs(b))


def _same_arrays(a: str, b: str) -> Column:
    """Equal lengths and all elements close."""
    near = F.forall(F.zip_with(a, b, _close), lambda x: x)
    return (F.size(a) == F.size(b)) & near


def tfidf_vectors_equal(spark: SparkSession, sf: str) -> DataFrame:
    """Per labelled document: are all slots of the vectors that the models read those computed by expressions?"""
    features = _feature_table(spark, sf)
    own = hashed.tfidf_slots(features, "doc_id", hashed.vector_words("cleaned_text"))
    rows = features.select("doc_id", vector_to_array("tfidf_features").alias("whole"))
    rows = rows.join(hashed.sparse_vectors(own, "doc_id"), "doc_id", "left")
    same = F.forall(F.zip_with("slots", "values", lambda s, v: _close(v, F.get("whole", s))), lambda x: x)
    filled = lambda c: F.size(F.filter(c, lambda x: x != 0))
    return rows.select(
        "doc_id",
        F.size("slots").cast("long").alias("n_slots"),
        (same & (filled("whole") == filled("values"))).alias("same"),
    )


def assemble(spark: SparkSession, sf: str) -> DataFrame:
    """Vector size and the four dense slots behind the hashed ones."""
    slots = vector_to_array("features")
    dense = [
        F.round(F.get(slots, F.lit(vectors.NUM_FEATURES + i)), 6).alias(name)
        for i, name in enumerate(vectors.DENSE_FEATURES)
    ]
    return vectors.assemble(_feature_table(spark, sf)).select(
        "doc_id", F.size(slots).cast("long").alias("vector_size"), *dense
    )


def split_rows(spark: SparkSession, sf: str) -> DataFrame:
    bucket = split_bucket("doc_id").alias("bucket")
    return assign_split(_docs(spark, sf), "doc_id").select("doc_id", bucket, "split")


def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    return assign_split(_docs(spark, sf), "doc_id").groupBy("split").agg(F.count("*").alias("n"))


# Models ----------------------------------------------------------------------
_fitted: dict[tuple[str, str, str], Model] = {}
_MODELS = {**md.COMPARED, md.NETWORK: md.feed_forward}


def _training_rows(spark: SparkSession, sf: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf, "training")
    if not _kept(spark, key):
        path = fresh_path(spark, "training")
        batch.write_training_rows(_feature_table(spark, sf), "doc_id", path)
        _paths[key] = path
    return tables.read_table(spark, _paths[key])


def _model(spark: SparkSession, sf: str, name: str) -> Model:
    """Fitted once per application and table folder."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _fitted:
        _fitted[key] = batch.fit(_MODELS[name], _training_rows(spark, sf))
    return _fitted[key]


def _test_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _training_rows(spark, sf).filter("split = 'test'")


def _predictions(name: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        scored = _model(spark, sf, name).transform(_test_rows(spark, sf))
        return scored.select("doc_id", "label", "label_idx", "prediction")

    return query


def rf_importance(spark: SparkSession, sf: str) -> DataFrame:
    return md.top_importances(spark, _model(spark, sf, "Random Forest"))


def _all_models(spark: SparkSession, sf: str) -> dict[str, Model]:
    return {name: _model(spark, sf, name) for name in _MODELS}


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    """Every test row by every model, written once."""
    key = (spark.sparkContext.applicationId, sf, "scored")
    if not _kept(spark, key):
        path = fresh_path(spark, "all-scored")
        scored = md.scored_rows(_all_models(spark, sf), _test_rows(spark, sf), "doc_id")
        tables.write_table(scored, path)
        _paths[key] = path
    return tables.read_table(spark, _paths[key])


def model_evaluation(spark: SparkSession, sf: str) -> DataFrame:
    """All four models with all five figures in one plan, beside the majority share."""
    classes = _test_rows(spark, sf).groupBy("label").agg(F.count("*").alias("n"))
    majority = classes.agg((F.max("n") / F.sum("n")).alias("majority_share"))
    return metrics.evaluation(_scored(spark, sf)).crossJoin(F.broadcast(majority))


def model_confusion(spark: SparkSession, sf: str) -> DataFrame:
    """The confusion matrix of each model: a row per actual class, a column per predicted one."""
    return metrics.confusion_matrix(_scored(spark, sf), [0.0, 1.0], "label_idx", by=("model",))


def model_confusion_totals(spark: SparkSession, sf: str) -> DataFrame:
    """What the matrices must add up to: per model and class the rows of the test part."""
    rows = model_confusion(spark, sf)
    said = [F.col(f"`{c}`") for c in rows.columns if c.startswith("predicted_")]
    labels = _test_rows(spark, sf).select("label_idx", "label").distinct()
    return rows.withColumn("n", sum(said[1:], said[0])).join(labels, "label_idx").select("model", "label", "n")


def evaluation_equal(spark: SparkSession, sf: str) -> DataFrame:
    """Per model: does the grouped evaluation give the figures of MLlib's evaluators?"""
    multi = MulticlassClassificationEvaluator(labelCol="label_idx", predictionCol="prediction")
    area = BinaryClassificationEvaluator(labelCol="label_idx", rawPredictionCol="score", numBins=0)
    names = {"accuracy": "accuracy", "f1": "f1", "precision": "weightedPrecision", "recall": "weightedRecall"}
    lines = []
    for name in _MODELS:
        rows = _scored(spark, sf).filter(F.col("model") == name)
        lines.append((name, *[multi.evaluate(rows, {multi.metricName: m}) for m in names.values()], area.evaluate(rows)))
    figures = [*names, "auc"]
    known = spark.createDataFrame(lines, "model string, " + ", ".join(f"of_{c} double" for c in figures))
    own = metrics.evaluation(_scored(spark, sf)).join(known, "model")
    return own.select("model", "n", *[_close(F.col(c), F.col(f"of_{c}")).alias(f"same_{c}") for c in figures])


def _compared(spark: SparkSession, sf: str) -> dict[str, Model]:
    return {name: _model(spark, sf, name) for name in md.COMPARED}


def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    return md.compare(_compared(spark, sf), _test_rows(spark, sf))


def best_model(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "best-model")
    return batch.select_best(_compared(spark, sf), _training_rows(spark, sf), path)


def best_model_saved(spark: SparkSession, sf: str) -> DataFrame:
    """Per test document: does the model saved as the best predict as the one with the highest weighted F1?

    The best is taken from each model's own predictions, not from the comparison.
    """
    path = fresh_path(spark, "best-model")
    batch.select_best(_compared(spark, sf), _training_rows(spark, sf), path)
    scored = _scored(spark, sf).filter(F.col("model").isin(list(md.COMPARED)))
    figures = metrics.class_metrics(scored, "label_idx", by=("model",)).orderBy(F.desc("weighted_f1"), "model").limit(1)
    best = scored.join(F.broadcast(figures.select("model")), "model", "left_semi").select("doc_id", F.col("prediction").alias("said"))
    saved = md.load_model(spark, path).transform(_test_rows(spark, sf)).select("doc_id", "prediction")
    return saved.join(best, "doc_id").select("doc_id", (F.col("said") == F.col("prediction")).alias("same"))


def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Per model and test document: does a model saved and loaded once more score the same?"""
    rows = _test_rows(spark, sf).select("doc_id", "features")

    def scores(model: Model, name: str) -> DataFrame:
        return model.transform(rows).select("doc_id", "prediction", vector_to_array("rawPrediction").alias(name))

    parts = []
    for name, model in _all_models(spark, sf).items():
        path = fresh_path(spark, "saved-model")
        md.save_model(model, path)
        loaded = scores(md.load_model(spark, path), "again").withColumnRenamed("prediction", "prediction_again")
        same = _same_arrays("fitted", "again") & (F.col("prediction") == F.col("prediction_again"))
        both = scores(model, "fitted").join(loaded, "doc_id")
        parts.append(both.select(F.lit(name).alias("model"), "doc_id", same.alias("same")))
    return reduce(DataFrame.unionByName, parts)


# Models checked by their parameters --------------------------------------------
def _values(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, slot, value of all labelled documents by expressions, written once."""
    key = (spark.sparkContext.applicationId, sf, "values")
    if not _kept(spark, key):
        path = fresh_path(spark, "values")
        tables.write_table(hashed.feature_values(_feature_table(spark, sf), "doc_id"), path)
        _paths[key] = path
    return tables.read_table(spark, _paths[key])


def _part(spark: SparkSession, sf: str, split: str) -> DataFrame:
    return _training_rows(spark, sf).filter(F.col("split") == split).select("doc_id", "label_idx")


def _margins(name: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        """Per test document: are the margin from the coefficient table and its sign the model's?"""
        model = _model(spark, sf, name)
        own = linear.margins(_values(spark, sf), _part(spark, sf, "test"), "doc_id", model)
        said = model.transform(_test_rows(spark, sf)).select(
            "doc_id", "prediction", vector_to_array("rawPrediction")[1].alias("raw")
        )
        sign = F.when(F.col("margin") > 0, 1.0).otherwise(0.0)
        return own.join(said, "doc_id").select(
            "doc_id", _close(F.col("margin"), F.col("raw")).alias("same_margin"), (sign == F.col("prediction")).alias("same_sign")
        )

    return query


# An optimum leaves no gradient; optimizers stop a little before it.  The hinge loss begins
# at 1; a hundred iterations may leave slopes of a few thousandths of it.
TOLERANCE, HINGE_TOLERANCE = 1e-4, 0.02


def lr_stationary(spark: SparkSession, sf: str) -> DataFrame:
    """Per slot (the intercept is -1): is the gradient of the regularised loss zero, up to TOLERANCE?"""
    model, train = _model(spark, sf, "Logistic Regression"), _part(spark, sf, "train")
    slots = linear.logistic_gradient(_values(spark, sf), train, "doc_id", model, model.getRegParam())
    rows = train.agg(F.count("*").alias("n_train"))
    return slots.select("slot", (F.abs("gradient") <= TOLERANCE).alias("stationary")).crossJoin(F.broadcast(rows))


def svm_certificate(spark: SparkSession, sf: str) -> DataFrame:
    """Per slot (the intercept is -1): does the hinge loss fall neither way, up to HINGE_TOLERANCE?"""
    model, train = _model(spark, sf, "Linear SVM"), _part(spark, sf, "train")
    slots = linear.hinge_slopes(_values(spark, sf), train, "doc_id", model)
    rows = train.agg(F.count("*").alias("n_train"))
    holds = F.least("up", "down") >= -HINGE_TOLERANCE
    return slots.select("slot", holds.alias("minimal")).crossJoin(F.broadcast(rows))


def rf_votes(spark: SparkSession, sf: str) -> DataFrame:
    """Per test document: do the trees, walked as a node table, vote as the model does?"""
    model = _model(spark, sf, "Random Forest")
    nodes = forest.node_table(model, _test_rows(spark, sf))
    own = forest.votes(_values(spark, sf), _part(spark, sf, "test"), "doc_id", nodes, model.getMaxDepth())
    said = model.transform(_test_rows(spark, sf)).select("doc_id", "prediction", vector_to_array("rawPrediction").alias("raw"))
    best = F.array_position("votes", F.array_max("votes")) - 1
    return own.join(said, "doc_id").select(
        "doc_id", _same_arrays("votes", "raw").alias("same_votes"), (best == F.col("prediction")).alias("same_prediction")
    )


def rf_importance_recomputed(spark: SparkSession, sf: str) -> DataFrame:
    """Per slot: is the importance summed from the nodes' gains the model's?"""
    model = _model(spark, sf, "Random Forest")
    own = forest.importances(forest.node_table(model, _test_rows(spark, sf)))
    rows = [(i, float(v)) for i, v in enumerate(model.featureImportances.toArray())]
    said = spark.createDataFrame(rows, "slot int, said double")
    same = _close(F.coalesce("importance", F.lit(0.0)), F.col("said"))
    trained = _part(spark, sf, "train").agg(F.count("*").alias("n_train"))
    return said.join(own, "slot", "left").select("slot", same.alias("same")).crossJoin(F.broadcast(trained))


def mlp_forward(spark: SparkSession, sf: str) -> DataFrame:
    """Per test document: are the network's probabilities those of matrix products over its weights?"""
    model = _model(spark, sf, md.NETWORK)
    test = _part(spark, sf, "test").select("doc_id")
    vectors = hashed.sparse_vectors(_values(spark, sf).join(test, "doc_id", "left_semi"), "doc_id", "value")
    own = network.probabilities(test.join(vectors, "doc_id", "left").select("doc_id", *[
        F.coalesce(c, F.array().cast(f"array<{t}>")).alias(c) for c, t in (("slots", "int"), ("values", "double"))
    ]), "doc_id", model)
    said = model.transform(_test_rows(spark, sf)).select("doc_id", vector_to_array("probability").alias("said"))
    return own.join(said, "doc_id").select("doc_id", _same_arrays("probabilities", "said").alias("same"))


# Rule classifier and its evaluation ------------------------------------------
def _ruled(spark: SparkSession, sf: str) -> DataFrame:
    df = _labelled(spark, sf).select("doc_id", "label", text.stream_clean("text").alias("cleaned"))
    return df.select(
        "doc_id",
        "label",
        rules.rule_label("cleaned", fixtures.STREAM_LEXICON).alias("prediction"),
        F.round(rules.rule_score("cleaned", fixtures.STREAM_LEXICON), 9).alias("score"),
    )


def rule_classify(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = _docs(spark, sf).select("doc_id", text.stream_clean("text").alias("cleaned"))
    return cleaned.select(
        "doc_id",
        rules.rule_label("cleaned", fixtures.STREAM_LEXICON).alias("prediction"),
        rules.rule_label("cleaned").alias("prediction_built_in"),
        F.round(rules.rule_score("cleaned", fixtures.STREAM_LEXICON), 6).alias("score"),
    )


def class_metrics(spark: SparkSession, sf: str) -> DataFrame:
    row = metrics.class_metrics(_ruled(spark, sf))
    return row.select("n", *[_exact(c) for c in row.columns if c != "n"])


def auc(spark: SparkSession, sf: str) -> DataFrame:
    scored = _ruled(spark, sf).withColumn("positive", F.col("label") == "ai")
    return metrics.area_under_roc(scored, "score", "positive").select(_exact("auc"))


def confusion(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion_matrix(_ruled(spark, sf), CLASSES)


# Streaming -------------------------------------------------------------------
def _write_messages(spark: SparkSession, sf: str, path: str) -> None:
    """At least two files, so that two micro-batches are possible."""
    fixtures.messages(spark, sf).select("value").write.mode("append").parquet(path)


def stream_score(spark: SparkSession, sf: str) -> DataFrame:
    source, sink = fresh_path(spark, "messages"), fresh_path(spark, "scored")
    _write_messages(spark, sf, source)
    stream = scoring.score(scoring.file_source(spark, source), fixtures.STREAM_LEXICON)
    scoring.run_available(stream, fresh_path(spark, "offsets"), sink)
    return spark.read.schema(stream.schema).parquet(sink).select(
        F.col("id").cast("long").alias("id"), "label", "prediction"
    )


def stream_restart(spark: SparkSession, sf: str) -> DataFrame:
    """Several micro-batches, a rerun without news and a rerun with more files."""
    source, sink = fresh_path(spark, "messages"), fresh_path(spark, "scored")
    offsets = fresh_path(spark, "offsets")
    _write_messages(spark, sf, source)
    stream = scoring.score(
        scoring.file_source(spark, source, files_per_batch=4), fixtures.STREAM_LEXICON
    )
    scoring.run_available(stream, offsets, sink)
    scoring.run_available(stream, offsets, sink)
    _write_messages(spark, sf, source)
    scoring.run_available(stream, offsets, sink)
    scored = spark.read.schema(stream.schema).parquet(sink)
    return scored.groupBy("prediction").agg(F.count("*").alias("n"))


def _batches(spark: SparkSession, sf: str, cut_at: int | None) -> DataFrame:
    """Scored messages by the batch sink, in several batches; ``cut_at``: the stream fails once after this batch's write."""
    source, sink = fresh_path(spark, "messages"), fresh_path(spark, "batches")
    offsets = fresh_path(spark, "offsets")
    rows = fixtures.messages(spark, sf).select("value", "source_id")
    rows.write.parquet(source)
    stream = scoring.score(scoring.file_source(spark, source, files_per_batch=1), fixtures.STREAM_LEXICON)

    def fail(batch: int) -> None:
        if batch == cut_at:
            raise ConnectionError("cut between the sink and the checkpoint")

    if cut_at is not None:
        try:
            scoring.append_batches(stream, offsets, sink, fail).awaitTermination()
        except StreamingQueryException:
            pass
        else:
            raise RuntimeError(f"there was no batch {cut_at} to be cut after")
    scoring.append_batches(stream, offsets, sink).awaitTermination()
    return spark.read.parquet(sink)


def stream_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Per message that has an id: rows, batches it came in, and times of its batch; one of each is right."""
    rows = _batches(spark, sf, None)
    times = rows.groupBy("batch").agg(F.countDistinct("timestamp").alias("times"))
    met = rows.filter("id IS NOT NULL").join(times, "batch")
    return met.groupBy(F.col("id").cast("long").alias("id")).agg(
        F.count("*").alias("n_rows"), F.countDistinct("batch").alias("n_batches"), F.max("times").alias("n_times")
    )


def stream_cut(spark: SparkSession, sf: str) -> DataFrame:
    """As ``stream_score``, cut once after a batch was written and before it was committed."""
    return _batches(spark, sf, 0).select(F.col("id").cast("long").alias("id"), "label", "prediction")


QUERIES: dict[str, Query] = {
    "scan_profile": scan_profile,
    "stopword_vocab": stopword_vocab,
    "processed_roundtrip": processed_roundtrip,
    "split_sinks": split_sinks,
    "raw_roundtrip": raw_roundtrip,
    "encode_messages": encode_messages,
    "encode_all_messages": encode_all_messages,
    "decode_messages": decode_messages,
    "unpivot_sources": unpivot_sources,
    "union_splits": union_splits,
    "source_counts_raw": source_counts_raw,
    "nonempty_rows": nonempty_rows,
    "sample_rows": sample_rows,
    "strip_diacritics": _per_document(lambda: {"stripped": text.strip_diacritics("text")}),
    "normalize_letters": _per_document(lambda: {"normalized": text.normalize_letters("text")}),
    "script_filter": _per_document(lambda: {"filtered": text.script_filter("text")}),
    "tokenize": _per_document(_tokenize),
    "remove_stopwords": remove_stopwords,
    "remove_stopwords_folded": remove_stopwords_folded,
    "drop_words_long": drop_words_long,
    "stem_vocab": stem_vocab,
    "clean_text": _per_document(lambda: {"cleaned_text": text.clean_text("text")}),
    "clean_text_stemmed": clean_text_stemmed,
    "stream_clean": _per_document(lambda: {"cleaned": text.stream_clean("text")}),
    "char_length": _per_document(lambda: {"n_chars": F.length("text").cast("long")}),
    "word_count": _per_document(
        lambda: {"n": tokens.single_space_word_count(text.clean_text("text")).cast("long")}
    ),
    "truncate_text": _per_document(
        lambda: {"head": F.substring("text", 1, messages.MAX_CHARS)}
    ),
    "bigram_rows": bigram_rows,
    "label_counts": label_counts,
    "source_counts": source_counts,
    "length_stats": length_stats,
    "null_profile": null_profile,
    "ttr_by_label": ttr_by_label,
    "clean_stats": clean_stats,
    "avg_words": avg_words,
    "word_count_top": word_count_top,
    "bigram_top": bigram_top,
    "feature_means": feature_means,
    "f15": _feature("f15", lambda: style.word_length_variance(F.col("tokens"))),
    "f36": _per_document(
        lambda: {"f36": F.round(style.sentences_per_paragraph("text").cast("double"), 6)}
    ),
    "f57": f57,
    "f78": _feature("f78", lambda: style.token_entropy(F.col("tokens"))),
    "features": features,
    "tfidf_terms": tfidf_terms,
    "label_index": label_index,
    "source_index": source_index,
    "hashed_tf": hashed_tf,
    "tfidf_slots": tfidf_slots,
    "tfidf_vectors": tfidf_vectors,
    "tfidf_vectors_equal": tfidf_vectors_equal,
    "assemble": assemble,
    "split_rows": split_rows,
    "split_counts": split_counts,
    "lr_predictions": _predictions("Logistic Regression"),
    "rf_predictions": _predictions("Random Forest"),
    "svm_predictions": _predictions("Linear SVM"),
    "mlp_predictions": _predictions("Feed Forward"),
    "rf_importance": rf_importance,
    "lr_margins": _margins("Logistic Regression"),
    "lr_stationary": lr_stationary,
    "svm_margins": _margins("Linear SVM"),
    "svm_certificate": svm_certificate,
    "rf_votes": rf_votes,
    "rf_importance_recomputed": rf_importance_recomputed,
    "mlp_forward": mlp_forward,
    "model_confusion": model_confusion,
    "model_confusion_totals": model_confusion_totals,
    "evaluation_equal": evaluation_equal,
    "model_evaluation": model_evaluation,
    "model_comparison": model_comparison,
    "best_model": best_model,
    "best_model_saved": best_model_saved,
    "model_roundtrip": model_roundtrip,
    "rule_classify": rule_classify,
    "class_metrics": class_metrics,
    "auc": auc,
    "confusion": confusion,
    "stream_score": stream_score,
    "stream_restart": stream_restart,
    "stream_batches": stream_batches,
    "stream_cut": stream_cut,
}
