"""The pipeline against each stage's plain version."""

import numpy as np
import public_tokenizers

import __spark_entry__ as contract
import corpus_pipeline as cp
from qirtas.llm import common, mil_classifier, quality_rules, substring_dedup
from qirtas.llm.queries import QUERIES, SQL
from qirtas.llm.words import tokenizer
from tests.llm.test_ngram_join import brute
from tests.llm.test_packing import check_whole
from tests.llm.test_substring_dedup import plain_dedup


def test_stages_and_run(spark, small):
    docs = start = common.table(spark, small, "documents")
    kept = {0: {r.doc_id: r.text for r in docs.collect()}}
    for k, (_, stage) in enumerate(cp.STAGES):
        out = cp.materialize(stage(spark, docs, small), f"test-stage-{k}")
        if k < 4:
            assert out.dtypes == start.dtypes
            kept[k + 1] = {r.doc_id: r.text for r in out.collect()}
        docs = out
    judged = {i: quality_rules.judge_text(t) for i, t in kept[0].items()}
    assert kept[1] == {i: j[10] for i, j in judged.items() if j[6]}
    labels = common.table(spark, small, "labels")
    first = spark.createDataFrame(list(kept[1].items()), "doc_id long, text string")
    model = mil_classifier.fit(first, labels)
    scores = model.scores([mil_classifier.passages(t) for t in kept[1].values()])
    assert set(kept[2]) == {i for i, s in zip(kept[1], scores, strict=True) if s >= 0.5}
    groups = brute(list(kept[2].items()))
    assert set(kept[3]) == {i for i, (_, c) in groups.items() if i == c} and len(kept[3]) < len(kept[2])
    assert kept[4] == {i: t for i, t, *_ in plain_dedup(list(kept[3].items()))}
    rows = docs.collect()
    sequences, pieces = check_whole(rows, 2048)
    encode = tokenizer(public_tokenizers.path("word_bpe_49k.json")).encode
    assert {i: p[0][2] for i, p in pieces.items()} == {i: len(encode(t, add_special_tokens=False).ids) + 1 for i, t in kept[4].items()}
    whole = cp.run(spark, small).collect()
    assert {(r.doc_id, r.start, r.ids_crc32) for r in whole} == {(r.doc_id, r.start, r.ids_crc32) for r in rows}


def test_clean_documents_stay():
    labelled = __import__("duckdb").sql(
        "SELECT text FROM '/root/testdata/sf0.01/documents.parquet' JOIN '/root/testdata/sf0.01/labels.parquet' USING (doc_id) WHERE quality = 1"
    ).fetchall()
    kept = np.mean([quality_rules.judge_text(t)[6] or quality_rules.judge_text(t)[5] for (t,) in labelled])
    assert kept > 0.995


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_empty_tables(spark, tmp_path):
    for name, schema in [("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, quality int, toxic int"), ("pages", "page_id long, url string, html string"), ("embeddings", "vec_id long, embedding array<float>, label int"), ("benchmark", "item_id long, text string")]:
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    for query in [*QUERIES.values(), cp.run]:
        assert query(spark, str(tmp_path)).count() == 0


def test_extra_columns_keep_their_names(spark):
    """Names with blanks and names that the stages use inside pass through the first four stages."""
    rows = [(i, " ".join(f"w{i * k % 97}x{k}" for k in range(60)) + ".", i % 2) for i in range(30)]
    extra = "`my col` int, judged string, _score string, _dedup string, _digest string, n_chars int"
    df = spark.createDataFrame([(i, t, 7, "a", "b", "c", "d", len(t)) for i, t, _ in rows], f"doc_id smallint, text string, {extra}")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    stages = [quality_rules.clean_documents, lambda d: mil_classifier.keep_good(d, labels, 0.0), substring_dedup.cut_documents]
    for stage in stages:
        out = stage(df)
        assert out.dtypes == df.dtypes
        assert {tuple(r[2:7]) for r in out.collect()} == {(7, "a", "b", "c", "d")}
