"""The registered queries against their SQL, and the pipeline's stages."""

from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from compare import difference, oracle_connection
from tests.llm import cases
from tripmart.llm import queries
from tripmart.llm.mixing import stored
from tripmart.session import shared_dir

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    assert difference(spark, oracle_connection(FOLDER), FOLDER, name) == ""


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))


def test_stages_take_effect_and_keep_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, labels = docs.columns, spark.read.parquet(f"{FOLDER}/labels.parquet")
    texts = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), "stage")
        if "text" in docs.columns:
            assert docs.columns == columns and docs.where("n_chars <> length(text)").count() == 0
            texts.append({r["doc_id"]: r["text"] for r in docs.collect()})
    first, second, third, _ = texts
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    bad = {r["doc_id"] for r in labels.where("quality = 0").collect()}
    assert len(bad & first.keys()) <= 1 + len(bad) // 20 and len(good - first.keys()) <= 1 + len(good) // 20
    assert len(set(second.values())) == len(second) < len(first) and second.keys() <= first.keys()
    assert set(first.values()) >= set(second.values()) and third.keys() == second.keys()
    assert any("[SECRET]" in t for t in third.values())
    assert docs.groupBy("sequence_id").agg({"length": "sum"}).where("`sum(length)` > 2048").count() == 0


CLASHES = ["_row", "_key", "_salt", "_k", "_s", "_id", "_first", "_out", "_size", "_order", "_shard", "_copy", "_spans", "_taken", "words", "class_id"]


def awkward(spark, rows):
    return rows.withColumns({c: F.lit(f"of {c}") for c in CLASHES})


@pytest.mark.parametrize("number", range(4))
def test_stages_of_awkward_documents(spark, tmp_path, number):
    spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = awkward(spark, cases.documents(spark))
    stage = corpus_pipeline.STAGES[number][1]
    out = stage(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    rows, given = out.collect(), docs.collect()
    assert all(r[c] == f"of {c}" for r in rows for c in CLASHES)
    assert all(r["n_chars"] == len(r["text"]) for r in rows if r["text"] is not None)
    assert stage(spark, docs.where("false"), str(tmp_path)).collect() == []
    if number == 0:  # equal texts go together
        kept = Counter(r["text"] for r in rows)
        assert all(n == sum(g["text"] == t for g in given) for t, n in kept.items())
    elif number == 1:  # one of each text, and near copies of the same class go
        assert len({r["text"] or "" for r in rows}) == len(rows) < len({g["text"] or "" for g in given})
        assert {r["text"] for r in rows} <= {g["text"] for g in given}
    elif number == 2:
        assert Counter(r["doc_id"] for r in rows) == Counter(g["doc_id"] for g in given)
        changed = {r["doc_id"]: r["text"] for r in rows if r["text"] not in {g["text"] for g in given}}
        assert any("[SECRET]" in t for t in changed.values()) and all("[SECRET]" in t for t in changed.values())
    else:
        most = Counter({d: 3 * n for d, n in Counter(g["doc_id"] for g in given).items()})
        assert all(cases.words(r["text"]) for r in rows) and not Counter(r["doc_id"] for r in rows) - most
        assert all(any((g["text"] or "").startswith(r["text"]) for g in given if g["doc_id"] == r["doc_id"]) for r in rows)


def test_packing_stage_of_awkward_documents(spark):
    docs = awkward(spark, cases.documents(spark))
    pieces = corpus_pipeline.packed(spark, docs, "").collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in docs.collect()}
    assert sum(r["start"] == 0 for r in pieces) == docs.count()
    assert corpus_pipeline.packed(spark, docs.where("false"), "").collect() == []


def test_the_run_leaves_only_what_its_result_reads(spark):
    folder = Path(shared_dir(spark, "probe").removeprefix("file:")).parent
    before = set(folder.iterdir())
    out = corpus_pipeline.run(spark, FOLDER)
    left = [p.name for p in set(folder.iterdir()) - before]
    assert len(left) == 1 and left[0].startswith("mixing-")
    assert out.where("start = 0").count() > 0
