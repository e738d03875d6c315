"""Corpora as they are published: three files of text and label, without ids."""

import pyarrow.parquet as pq
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import entry_queries
from lexigrade import session
from lexigrade.plans.features import FeatureParams, fit_vectors, preprocess
from lexigrade.sources import corpus


def write(spark, path, texts, files):
    """``texts`` in order, as the given number of files."""
    step = -(-len(texts) // files)
    rows = spark.createDataFrame([(t, f"label {i % 3}") for i, t in enumerate(texts)], "text string, label string")
    rows.coalesce(1).write.option("maxRecordsPerFile", step).parquet(path)


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("published"))
    texts = {"train": [f"train {i}" if i % 50 else None for i in range(1700)], "test": ["", "b", "b"], "validation": [f"v{i}" for i in range(40)]}
    for split, files in (("train", 4), ("test", 1), ("validation", 3)):
        write(spark, f"{base}/{split}", texts[split], files)
    return base, texts


def read(spark, base, splits=corpus.SPLITS):
    return corpus.read_corpus(spark, {s: f"{base}/{s}" for s in splits})


@pytest.mark.parametrize("bytes_per_task", ["1g", "2k"])
@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_ids_follow_the_rows_over_all_files(spark, published, monkeypatch, bytes_per_task, broadcast_rows):
    """Dense, disjoint ids in file order on one task or many, whether the file table is broadcast or joined."""
    base, texts = published
    monkeypatch.setattr(session, "BROADCAST_ROWS", broadcast_rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_per_task)
    rows = read(spark, base).collect()
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = [(r["split"], r["text"]) for r in sorted(rows, key=lambda r: r["doc_id"])]
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: r["doc_id"])] == list(range(1743))
    assert got == [(s, t) for s in ("train", "validation", "test") for t in texts[s]]


def test_splits_given_in_any_order_or_left_out(spark, published):
    base, texts = published
    swapped = corpus.read_corpus(spark, {s: f"{base}/{s}" for s in ("test", "train", "validation")})
    assert swapped.exceptAll(read(spark, base)).count() == 0
    part = read(spark, base, ("test", "validation")).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["text"]) for r in part] == list(enumerate(texts["validation"] + texts["test"]))


def test_reading_moves_no_text(spark, published):
    text = read(spark, published[0]).select("doc_id", "label")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text and "text:string" not in text, text


def test_ids_of_the_files_are_taken_on_request(spark, tmp_path):
    for split, ids in (("train", (5, 3)), ("test", (9,))):
        spark.createDataFrame([(i, f"t{i}", "x") for i in ids], "n long, text string, label string").write.parquet(f"{tmp_path}/{split}")
    rows = corpus.read_corpus(spark, {s: f"{tmp_path}/{s}" for s in ("train", "test")}, "n").collect()
    assert {(r["doc_id"], r["text"], r["split"]) for r in rows} == {(5, "t5", "train"), (3, "t3", "train"), (9, "t9", "test")}


def test_empty_files_and_published_names(spark, tmp_path):
    docs = entry_queries.documents(spark, SF_SMALL).withColumn("label", F.col("lang"))
    for split in corpus.SPLITS:
        rows = docs.where(f"split = '{split}'").select("text", "label")
        rows = rows.limit(0) if split == "validation" else rows
        (tmp_path / "volume").mkdir(exist_ok=True)
        pq.write_table(rows.toArrow(), f"{tmp_path}/volume/{split}-00000-of-00001.parquet")
    read_back = corpus.read_corpus(spark, corpus.level_files(str(tmp_path), "volume"))
    n = docs.where("split <> 'validation'").count()
    assert sorted(r["doc_id"] for r in read_back.collect()) == list(range(n))
    # A corpus without ids goes through the whole preparation.
    space, vectors = fit_vectors(read_back, FeatureParams(300, 10, 0), ("split", "label"))
    data = preprocess(space, vectors, "label", 20)
    assert data.n_train == read_back.where("split = 'train'").count() and data.rows.select("doc_id").distinct().count() == n
