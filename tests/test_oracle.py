"""Each registered query vs its DuckDB oracle SQL on the sf0.001 tables."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF0001
from tools.oracle_check import TABLES, compare

FAST = [n for n in E.oracle_sql() if n not in ("image_blend", "image_dense")]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    st, a, b, _, msg = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF0001)
    assert st == "OK", (name, st, a, b, msg)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() == 145
    assert "LepPt" in df.columns and "label" in df.columns


def test_every_query_has_oracle_or_is_rows_only():
    rows_only = {"rf_predict", "mlp_predict", "grid_search", "random_search", "inclusive_predict",
                 "training_loss", "trained_auc", "trained_confusion"}
    missing = set(E.QUERIES) - set(E.ORACLE)
    assert missing == rows_only, missing
