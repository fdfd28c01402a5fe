"""Written tables that are gone."""

from types import SimpleNamespace

import pytest

from qirtas import storage
from qirtas.plans import queries


def test_a_table_that_is_gone_is_written_again(spark, small, monkeypatch):
    builds = []

    def build():
        builds.append(1)
        return spark.range(3)

    for _ in range(2):
        assert storage.materialize_once(spark, "some/three", build).count() == 3
    assert len(builds) == 1
    key = (spark.sparkContext.applicationId, "some/three")
    monkeypatch.setitem(storage._written, key, (storage.fresh_path(spark, "gone"), storage._written[key][1]))
    assert storage.materialize_once(spark, "some/three", build).count() == 3 and len(builds) == 2


def test_queries_outlive_their_written_inputs(spark, small, monkeypatch):
    before = queries.label_counts(spark, small).collect()
    gone = {k: (storage.fresh_path(spark, "gone"), schema) for k, (_, schema) in storage._written.items()}
    monkeypatch.setattr(storage, "_written", gone)
    assert sorted(queries.label_counts(spark, small).collect()) == sorted(before)
    monkeypatch.setattr(queries, "_paths", {})
    rows = queries._feature_table(spark, small).count()
    monkeypatch.setattr(queries, "_paths", {k: storage.fresh_path(spark, "gone") for k in queries._paths})
    assert queries._feature_table(spark, small).count() == rows


def test_a_write_that_broke_is_not_kept(spark, tmp_path):
    assert not storage.is_written(spark, str(tmp_path))


def test_a_mounted_folder_serves_a_cluster(spark, tmp_path, monkeypatch):
    trials = []

    def tried(spark, path, cores, plain=storage.is_mounted):
        trials.append(path)
        return plain(spark, path, cores)

    folder = f"file://{tmp_path}/mounted"
    monkeypatch.setattr(spark.sparkContext, "master", "spark://driver:7077")
    monkeypatch.setattr(storage, "is_mounted", tried)
    monkeypatch.setattr(storage, "_tried", {})
    monkeypatch.setattr(storage, "_SETTING", "qirtas.test.folder")
    spark.conf.set("qirtas.test.folder", f"{folder}/")
    try:
        for _ in range(2):
            df = storage.materialize(spark.range(5), "five")
            assert df.count() == 5 and all(f.startswith(f"file://{tmp_path}/mounted/") for f in df.inputFiles())
        assert len(trials) == 1
        monkeypatch.setattr(storage, "_tried", {k: n - 1 for k, n in storage._tried.items()})
        assert storage.shared_folder(spark) == folder and len(trials) == 2  # cores have joined
    finally:
        spark.conf.unset("qirtas.test.folder")


def test_a_trial_that_loses_rows_or_breaks_refuses_the_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "_tried", {})
    monkeypatch.setattr(storage, "is_mounted", lambda *_: False)
    with pytest.raises(RuntimeError, match="is a local folder"):
        storage.require_mounted(spark, str(tmp_path))
    (tmp_path / "file").write_text("")
    monkeypatch.undo()
    with pytest.raises(RuntimeError, match="is a local folder") as refused:
        storage.require_mounted(spark, f"{tmp_path}/file")
    assert refused.value.__cause__ is not None


@pytest.mark.parametrize("found, mounted", [(4, True), (3, False), (0, False)])
def test_rows_left_on_an_executors_own_disk_are_missed(spark, tmp_path, found, mounted):
    reader = SimpleNamespace(parquet=lambda path: spark.read.parquet(path).limit(found))
    session = SimpleNamespace(range=spark.range, read=SimpleNamespace(schema=lambda schema: reader))
    assert storage.is_mounted(session, str(tmp_path / "rows"), 4) == mounted
