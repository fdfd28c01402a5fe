"""The scoring stream over files: batches, malformed input, restart, parity with batch."""

import json
import os
from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from qirtas.functions.rules import rule_label
from qirtas.functions.text import stream_clean
from qirtas.streaming import scoring
from tests import brute

LEXICON = ["درس", "بحث", "علم", "جمع"]
TEXTS = ["درس بحث علم", "استخدمت الدراسه", "", None, "abc", "ا ب ت", "مؤتمر، ئ", "جمع " * 3]
BAD = ["{", "", "<html>", '{"text": 1']


def _write(spark, path, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    df.select(F.col("value").cast("binary")).coalesce(1).write.mode("append").parquet(path)


def _lines(start=0):
    good = [
        json.dumps({"text": t, "label": "ai", "id": start + i}, ensure_ascii=False)
        for i, t in enumerate(TEXTS)
    ]
    return good + BAD


@pytest.fixture
def folders(tmp_path):
    return [str(tmp_path / n) for n in ("in", "out", "offsets")]


def _run(spark, folders, per_batch=None):
    source, sink, offsets = folders
    stream = scoring.score(scoring.file_source(spark, source, per_batch), LEXICON)
    scoring.run_available(stream, offsets, sink, timeout=120)
    return spark.read.schema(stream.schema).parquet(sink)


def test_each_message_gives_one_row(spark, folders):
    _write(spark, folders[0], _lines())
    rows = _run(spark, folders).collect()
    assert len(rows) == len(TEXTS) + len(BAD)
    expected = Counter(
        [(i, "ai", brute.rule(brute.light(t), LEXICON)) for i, t in enumerate(TEXTS)]
        + [(None, None, "unknown")] * len(BAD)
    )
    assert Counter((r["id"], r["label"], r["prediction"]) for r in rows) == expected
    assert all(r["timestamp"] is not None for r in rows)


def test_batches_and_restart(spark, folders):
    for k in range(3):
        _write(spark, folders[0], _lines(100 * k))
    n = len(TEXTS) + len(BAD)
    first = _run(spark, folders, per_batch=1)
    assert first.count() == 3 * n
    assert first.select("timestamp").distinct().count() == 3
    assert _run(spark, folders, per_batch=1).count() == 3 * n
    _write(spark, folders[0], _lines(900))
    assert _run(spark, folders, per_batch=1).count() == 4 * n


def test_stream_equals_batch(spark, folders):
    lines = _lines()
    _write(spark, folders[0], lines)
    batch = spark.createDataFrame([(x,) for x in lines], "value string")
    columns = ["id", "label", "prediction"]
    a = Counter(tuple(r) for r in scoring.score(batch, LEXICON).select(*columns).collect())
    b = Counter(tuple(r) for r in _run(spark, folders).select(*columns).collect())
    assert a == b
    direct = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    labels = direct.select(rule_label(stream_clean("text"), LEXICON)).collect()
    assert Counter(r[0] for r in labels) + Counter(unknown=len(BAD)) == Counter(p for _, _, p in a.elements())


def test_console_sink(spark, folders):
    _write(spark, folders[0], _lines())
    stream = scoring.score(scoring.file_source(spark, folders[0]), LEXICON)
    query = scoring.append_to(stream, folders[2], available_now=True)
    query.awaitTermination(120)
    assert query.exception() is None and not query.isActive


def test_kafka_options():
    """Only the options are checked: there is no broker and no connector here."""

    class Reader:
        def __init__(self):
            self.seen = {}

        def format(self, name):
            self.seen["format"] = name
            return self

        def option(self, key, value):
            self.seen[key] = value
            return self

        def load(self):
            return self.seen

    class Session:
        readStream = Reader()

    assert scoring.kafka_source(Session(), "host:9092", "texts") == {
        "format": "kafka",
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "texts",
        "startingOffsets": "latest",
    }


def test_kafka_starts_where_it_is_told():
    class Reader(dict):
        def format(self, name):
            return self

        def option(self, key, value):
            self[key] = value
            return self

        def load(self):
            return self

    class Session:
        readStream = Reader()

    assert scoring.kafka_source(Session(), "h:1", "t", "earliest")["startingOffsets"] == "earliest"


def test_recovery_from_a_cut_before_the_commit(spark, folders):
    """The sink has the last batch in its log, the checkpoint has not: it runs again and nothing comes twice."""
    for k in range(3):
        _write(spark, folders[0], _lines(100 * k))
    columns = ["id", "label", "prediction", "timestamp"]
    before = Counter(tuple(r) for r in _run(spark, folders, per_batch=1).select(*columns).collect())
    commits = os.path.join(folders[2], "commits")
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))
    _write(spark, folders[0], _lines(900))
    after = Counter(tuple(r) for r in _run(spark, folders, per_batch=1).select(*columns).collect())
    n = len(TEXTS) + len(BAD)
    assert os.path.exists(os.path.join(commits, last))
    assert sum(after.values()) == 4 * n and not before - after


@pytest.mark.parametrize("cut", [0, 2])
def test_batches_are_whole_after_a_cut(spark, folders, cut):
    """The stream fails between a batch's write and its commit; the rerun replaces that batch."""
    source, sink, offsets = folders
    for k in range(3):
        _write(spark, source, _lines(100 * k))
    stream = scoring.score(scoring.file_source(spark, source, 1), LEXICON)

    def fail(batch):
        if batch == cut:
            raise ConnectionError("cut")

    with pytest.raises(StreamingQueryException):
        scoring.append_batches(stream, offsets, sink, fail).awaitTermination()
    assert spark.read.parquet(sink).select("batch").distinct().count() == cut + 1
    for _ in range(2):
        scoring.append_batches(stream, offsets, sink).awaitTermination()
    rows = spark.read.parquet(sink)
    assert rows.count() == 3 * (len(TEXTS) + len(BAD))
    assert rows.groupBy("batch").agg(F.countDistinct("timestamp").alias("n")).filter("n != 1").count() == 0
    assert rows.filter("id IS NOT NULL").groupBy("id").count().filter("count != 1").count() == 0
