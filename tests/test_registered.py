"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import glob
import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidemark.plans.registered import ORACLES, QUERIES

SF = os.environ.get("TIDEMARK_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(file).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{file}'")
    return con


def test_every_query_of_the_library_has_sql():
    """The training-data queries are tested by their own package's tests; some have SQL too."""
    assert set(ORACLES) == set(QUERIES) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows_as_sql(spark, duck, rows, name):
    df = queries()[name](spark, SF)
    cols = sorted(df.columns)
    listed = ", ".join(f'"{c}"' for c in cols)
    expected = duck.sql(f"SELECT {listed} FROM ({oracle_sql()[name]})").fetchall()
    assert rows(df.select(*cols)) == sorted(expected, key=repr)


def test_every_event_lands_however_far_the_ids_reach(spark, path, rows):
    """Rows of the second run whose ids were far below the first run's greatest were taken for landed."""
    data = path("far")
    ids = [0, 1, 2, 3, 1_999_999, 2_000_000, 3_000_000, 4_000_000_000_001]
    spark.createDataFrame([(i, i + 1, "click", 0.5) for i in ids] + [(None, 1, "view", 1.0)],
                          "event_id long, user_id long, event_type string, value double").write.parquet(f"{data}/events.parquet")
    found = queries()["run_incremental_other_zone"](spark, data)
    assert rows(found, "event_id") == sorted([(i,) for i in [*ids, None]], key=repr)


def test_missing_keys_are_looked_up_among_all_orders(spark, path, rows):
    """Orders of every price count: a customer with a small order only is not missing."""
    data = path("keys")
    spark.createDataFrame([(1,), (2,), (3,)], "c_custkey long").write.parquet(f"{data}/customer.parquet")
    spark.createDataFrame([(1, 10.0), (2, 500_000.0), (9, None)], "o_custkey long, o_totalprice double").write.parquet(f"{data}/orders.parquet")
    assert rows(queries()["missing_keys"](spark, data)) == [(3,)]
    assert "WHERE" not in oracle_sql()["missing_keys"]


def test_documents_are_not_funnelled_through_one_task(spark, path, rows, monkeypatch):
    """A file per split of the table, each of them several splits long and read as such."""
    data, out = path("docs"), path("csv")
    monkeypatch.setattr("tidemark.plans.registered.files.fresh", lambda *_: out)
    texts = [(i, f'line {i}\nsays "{i}", ' + "and on\n" * 200) for i in range(60)]
    spark.createDataFrame(texts, "doc_id long, text string").repartition(4).write.option("compression", "none").parquet(f"{data}/documents.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        assert rows(queries()["csv_documents_split"](spark, data)) == sorted(texts, key=repr)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(glob.glob(f"{out}/*.csv")) > 1
