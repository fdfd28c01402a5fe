"""The stages one after another, as a user would submit them."""

import pytest
from pyspark.sql import functions as F

from qirtas.__main__ import main
from qirtas.operators.models import load_model
from qirtas.sources import fixtures

METHODS = ["by_polishing", "from_title", "from_title_and_content"]


def test_stages(spark, small, tmp_path, capsys):
    at = lambda name: str(tmp_path / name)
    wide = fixtures.wide_abstracts(spark, small)
    for name in fixtures.AI_COLUMNS + [fixtures.HUMAN_COLUMN]:
        wide = wide.withColumn(name, fixtures.transliterate(name))
    for m in METHODS:
        part = wide.filter(F.col("generation_method") == m).drop("generation_method")
        part.write.parquet(at(m))
    (tmp_path / "stop.txt").write_text("\n".join(fixtures.STOPWORDS), encoding="utf-8")

    main(["acquire", "--wide", *[f"{m}={at(m)}" for m in METHODS], "--out", at("raw")])
    raw = spark.read.parquet(at("raw"))
    assert raw.columns == ["text", "label", "generation_method", "source_model"]
    assert raw.count() == 87

    main(["process", "--raw", at("raw"), "--stopwords", at("stop.txt"), "--out", at("processed")])
    processed = spark.read.parquet(at("processed"))
    assert "cleaned_text" in processed.columns and 0 < processed.count() <= 87
    keyed = processed.withColumn("k", F.xxhash64("text", "source_model"))
    keyed.write.parquet(at("keyed"))

    main(["profile", "--table", at("processed")])
    assert "avg_ttr" in capsys.readouterr().out
    main(["features", "--table", at("keyed"), "--key", "k", "--out", at("features")])
    features = spark.read.parquet(at("features"))
    assert features.count() == processed.count()
    assert {"f15_word_len_variance", "tfidf_features", "label_idx", "split"} <= set(features.columns)

    main(["train", "--table", at("features"), "--key", "k", "--model", at("best"), "--network", at("network"),
          "--hidden", "4", "--tasks", "2"])
    report = capsys.readouterr().out
    assert all(name in report for name in ("Feed Forward", "precision", "recall", "predicted_other"))
    assert load_model(spark, at("network")).getLayers() == [5004, 4, 2]
    assert load_model(spark, at("best")).numFeatures == 5004

    main(["encode", "--table", at("keyed"), "--key", "k", "--rows", "10", "--chars", "20", "--out", at("messages")])
    sent = spark.read.parquet(at("messages")).select(F.get_json_object(F.col("value").cast("string"), "$.text"))
    assert max(len(r[0]) for r in sent.collect()) == 20
    main(["stream", "--input", at("messages"), "--checkpoint", at("offsets"),
          "--out", at("scored"), "--seconds", "8"])
    scored = spark.read.parquet(at("scored"))
    assert sorted(r["id"] for r in scored.collect()) == list(range(10))


def test_unknown_stage():
    with pytest.raises(SystemExit):
        main(["nothing"])
