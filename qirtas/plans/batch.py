"""The batch chain: raw -> processed -> features and splits -> models.

Every stage writes a table and the next one reads it, so no stage recomputes
the text work of an earlier one, and a lost executor costs a re-read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame

from qirtas.functions.lexicons import TOP_WORDS
from qirtas.functions.stem import stem_text
from qirtas.operators import models as md
from qirtas.operators.features import with_cleaned, with_features
from qirtas.operators.split import assign_split
from qirtas.operators.vectors import assemble, fit_tfidf
from qirtas.sources.tables import read_table, write_table
from qirtas.sources.wordlists import drop_words, literal_words
from qirtas.storage import fresh_path

# Training rows of a task of a fit.  Trees and the network have at least FIT_TASKS tasks; an
# iteration of a linear model is so short that further tasks cost more than they save.
FIT_TASKS, FIT_ROWS = 8, 20_000


def process(
    raw: DataFrame, path: str, stopwords: Iterable[str] | DataFrame = (), stem: bool = True
) -> DataFrame:
    """Clean the raw table, write it to ``path`` and return the written table.

    ``stopwords`` are words, or a frame with a column ``word`` of any length.
    """
    if isinstance(stopwords, DataFrame):
        listed = literal_words(stopwords)
        if listed is None:
            cleaned = drop_words(with_cleaned(raw), "cleaned_text", stopwords)
            if stem:
                cleaned = cleaned.withColumn("cleaned_text", stem_text("cleaned_text"))
            write_table(cleaned, path)
            return read_table(raw.sparkSession, path)
        stopwords = listed
    write_table(with_cleaned(raw, stopwords=stopwords, stem=stem), path)
    return read_table(raw.sparkSession, path)


def write_features(
    processed: DataFrame,
    key: str,
    path: str,
    lexicon: Iterable[str] = TOP_WORDS,
    fit_on: str = "all",
) -> DataFrame:
    """Features, vectors, label index and split, partitioned by split.

    One write instead of three, and readers of one part prune the others.
    """
    rows = assign_split(with_features(processed, lexicon=lexicon), key)
    vectors = fit_tfidf(rows, fit_on).transform(rows)
    write_table(vectors, path, partition_by=("split",))
    return read_table(processed.sparkSession, path)


def write_training_rows(features: DataFrame, key: str, path: str | None = None) -> DataFrame:
    """Only what the iterative fits need: key, label, index, assembled vector, split."""
    path = path or fresh_path(features.sparkSession, "assembled")
    rows = assemble(features).select(key, "label", "label_idx", "features", "split")
    write_table(rows, path, partition_by=("split",))
    return read_table(features.sparkSession, path)


def fit(
    estimator: Callable[[], Estimator], rows: DataFrame, key: str = "doc_id", tasks: int | None = None
) -> Model:
    """Fit on the training part, dealt to ``tasks`` tasks by key and ordered there.

    Trees draw their samples and the network its batches by task and row order, so
    this order makes the model depend on the rows, ``tasks`` and nothing else: not
    on the files, the cluster or a retry.  Without ``tasks`` there is one for every
    FIT_ROWS rows, and FIT_TASKS at least but for linear models.

    The model is saved and loaded again: a fresh one keeps a training summary, and
    with it the session, in every closure that scores rows.
    """
    train = rows.filter("split = 'train'").select(key, "label_idx", "features")
    unfitted = estimator()
    if tasks is None:
        least = 1 if isinstance(unfitted, md.LINEAR) else FIT_TASKS
        tasks = max(least, -(-train.count() // FIT_ROWS))
    dealt = train.repartition(tasks, key).sortWithinPartitions(key)
    path = fresh_path(rows.sparkSession, "model")
    md.save_model(unfitted.fit(dealt.select("label_idx", "features")), path)
    return md.load_model(rows.sparkSession, path)


def select_best(
    fitted: dict[str, Model],
    rows: DataFrame,
    path: str,
    select_on: str = "test",
    compared: DataFrame | None = None,
) -> DataFrame:
    """Save the model with the highest weighted F1 on one part; returns its line.

    ``select_on="test"`` gives the reference results; ``"val"`` leaves the test
    part untouched by the choice.  ``compared`` is a comparison on that part made
    before.
    """
    if compared is None:
        compared = md.compare(fitted, rows.filter(f"split = '{select_on}'"))
    best = md.best_model(compared)
    md.save_model(fitted[best.first()["model"]], path)
    return best
