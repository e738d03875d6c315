import duckdb
import oracle_check
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry
import entry_queries
import entry_sql
from lexigrade.plans import runs

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle_check.connect(SF_SMALL)


def test_registration():
    assert set(ORACLES) <= set(entry.queries()) and set(entry_queries.QUERIES) <= set(entry.queries())
    assert set(entry_queries.QUERIES) == set(entry_sql.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert oracle_check.compare(spark, duck, SF_SMALL, name, ORACLES[name]) is None


def test_lr_run_takes_all_iterations(spark, monkeypatch, tmp_path):
    """Three of ten documents have the other label: few steps call every document by the frequent one."""
    ids = list(range(100))
    langs = ["b" if i % 20 < 6 else "a" for i in ids]
    common = " ".join(f"f{k:02d} f{k:02d}" for k in range(30))
    texts = [f"{common} w{lang}" for lang in langs]
    documents = {"doc_id": ids, "text": texts, "lang": langs, "source": ["s"] * 100, "n_chars": [len(t) for t in texts]}
    marks = {"doc_id": ids, "quality": pa.array([1] * 100, pa.int32()), "toxic": pa.array([0] * 100, pa.int32())}
    con = duckdb.connect()
    for name, columns in (("documents", documents), ("labels", marks)):
        pq.write_table(pa.table(columns), tmp_path / f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    kept, run = [], runs.lr_run
    monkeypatch.setattr(runs, "lr_run", lambda *given: kept.append(run(*given)) or kept[-1])
    assert oracle_check.compare(spark, con, str(tmp_path), "lr_run", ORACLES["lr_run"]) is None
    assert kept[0].fit.iterations == {0: 300, 1: 300}
    assert {r["accuracy"] for r in kept[0].summary.collect()} == {1.0}
    assert {(r["iteration"], r["accuracy"]) for r in kept[0].curve.collect()} == {(100, 0.7), (200, 1.0), (300, 1.0)}
    assert "MapInArrow" not in kept[0].curve._jdf.queryExecution().executedPlan().toString()


def test_entry(spark):
    assert entry.entry(spark).columns == ["term", "tf", "df", "idf"]
