"""Command line for spark-submit: one subcommand per stage.

    acquire  --wide METHOD=PATH ... --out DIR       wide tables -> raw table
    process  --raw DIR --out DIR [--stopwords FILE] raw -> cleaned table
    profile  --table DIR                            statistics of a cleaned table
    features --table DIR --key COL --out DIR        features, vectors, splits
    train    --table DIR --key COL --model DIR      fit, compare, save the best
    encode   --table DIR --key COL --out DIR        sample -> JSON lines
    stream   --input DIR | --kafka HOST --topic T   score messages
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from qirtas.functions.text import fold
from qirtas.operators import corpus, metrics, reshape
from qirtas.operators import models as md
from qirtas.plans import batch
from qirtas.sources import messages, tables, wordlists
from qirtas.streaming import scoring


def acquire(spark: SparkSession, args: argparse.Namespace) -> None:
    parts = dict(item.split("=", 1) for item in args.wide)
    wide = reshape.union_splits({m: tables.read_table(spark, p) for m, p in parts.items()})
    tables.write_table(reshape.unpivot_sources(wide), args.out)
    raw = tables.read_table(spark, args.out)
    corpus.value_counts(raw, "label").show()
    corpus.value_counts(raw, "source_model").show()
    corpus.length_stats(raw).show()
    corpus.null_profile(raw).show()


def process(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = tables.read_table(spark, args.raw)
    words = ()
    if args.stopwords:
        words = wordlists.load_words(spark, args.stopwords)
        if args.fold_stopwords:
            words = words.select(fold("word").alias("word")).distinct()
    batch.process(raw, args.out, words, stem=not args.no_stem)


def profile(spark: SparkSession, args: argparse.Namespace) -> None:
    df = tables.read_table(spark, args.table)
    corpus.ttr_by_label(df).show()
    corpus.clean_stats(df).show()
    corpus.avg_words(df).show()
    corpus.top_words(df).show(truncate=False)
    corpus.top_bigrams(df).show(truncate=False)


def features(spark: SparkSession, args: argparse.Namespace) -> None:
    processed = tables.read_table(spark, args.table)
    written = batch.write_features(processed, args.key, args.out, fit_on=args.fit_on)
    corpus.feature_means(written).show()
    corpus.value_counts(written, "split").show()


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = batch.write_training_rows(tables.read_table(spark, args.table), args.key)
    network = md.feed_forward((md.VECTOR_SIZE, *args.hidden, args.classes))
    fitted = {n: batch.fit(e, rows, args.key, args.tasks) for n, e in md.COMPARED.items()}
    chosen = dict(fitted)
    fitted[md.NETWORK] = batch.fit(lambda: network, rows, args.key, args.tasks)
    md.top_importances(spark, fitted["Random Forest"]).show()
    scored = md.scored_rows(fitted, rows.filter("split = 'test'"))
    report = metrics.evaluation(scored)
    report.orderBy("model").show(truncate=False)
    classes = [float(k) for k in range(args.classes)]
    metrics.confusion_matrix(scored, classes, "label_idx", by=("model",)).orderBy("model", "label_idx").show(truncate=False)
    known = report.filter(F.col("model") != md.NETWORK) if args.select_on == "test" else None
    batch.select_best(chosen, rows, args.model, args.select_on, known).show()
    if args.network:
        md.save_model(fitted[md.NETWORK], args.network)


def encode(spark: SparkSession, args: argparse.Namespace) -> None:
    sample = messages.numbered_sample(tables.read_table(spark, args.table), args.key, args.rows, args.chars)
    value = messages.encode(F.col("text"), F.col("label"), F.col("id"), args.chars).alias("value")
    lines = sample.select(value)
    if args.kafka:
        messages.write_to_kafka(lines, args.kafka, args.topic)
    else:
        lines.select(F.col("value").cast("binary")).write.mode("overwrite").parquet(args.out)


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    source = (
        scoring.kafka_source(spark, args.kafka, args.topic, args.starting_offsets)
        if args.kafka
        else scoring.file_source(spark, args.input)
    )
    if args.drain:
        scoring.run_available(scoring.score(source), args.checkpoint, args.out, args.seconds or None)
        return
    query = scoring.append_to(scoring.score(source), args.checkpoint, args.out)
    if args.seconds:
        query.awaitTermination(args.seconds)
        query.stop()
    else:
        query.awaitTermination()


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser("qirtas", description=__doc__)
    commands = parser.add_subparsers(required=True)

    def command(run, *required: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(run.__name__)
        for name in required:
            sub.add_argument(f"--{name}", required=True)
        sub.set_defaults(run=run)
        return sub

    command(acquire, "out").add_argument("--wide", nargs="+", required=True)
    sub = command(process, "raw", "out")
    sub.add_argument("--stopwords")
    sub.add_argument("--fold-stopwords", action="store_true")
    sub.add_argument("--no-stem", action="store_true")
    command(profile, "table")
    command(features, "table", "key", "out").add_argument(
        "--fit-on", choices=["all", "train"], default="all"
    )
    sub = command(train, "table", "key", "model")
    sub.add_argument("--select-on", choices=["test", "val"], default="test")
    sub.add_argument("--tasks", type=int, help="of each iteration; by default from the number of rows")
    sub.add_argument("--hidden", type=int, nargs="+", default=[256, 128], help="layers of the network")
    sub.add_argument("--classes", type=int, default=2)
    sub.add_argument("--network", help="where the network is saved")
    sub = command(encode, "table", "key")
    sub.add_argument("--rows", type=int, default=messages.SAMPLE_ROWS)
    sub.add_argument("--chars", type=int, default=messages.MAX_CHARS)
    for name in ("out", "kafka", "topic"):
        sub.add_argument(f"--{name}")
    sub = command(stream, "checkpoint")
    sub.add_argument("--seconds", type=float, default=90, help="0: until it is stopped")
    sub.add_argument("--starting-offsets", default="latest")
    sub.add_argument("--drain", action="store_true", help="end when the input is processed")
    for name in ("input", "kafka", "topic", "out"):
        sub.add_argument(f"--{name}")

    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("qirtas").getOrCreate()
    args.run(spark, args)


if __name__ == "__main__":
    main()
