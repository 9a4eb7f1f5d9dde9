"""Driver contract: entry, queries and oracle SQL."""

import importlib.util
import os

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


def entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry",
                                                  os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    df = entry_module().entry(spark)
    rows = df.collect()
    people = duckdb.sql(f"select count(*) from '{SF}/customer.parquet'").fetchall()[0][0]
    assert len(rows) == people > 140
    assert df.columns[-5:] == ["n_sent", "n_received", "n_from_poi", "n_to_poi", "poi"]


def test_oracle_keys_are_queries():
    mod = entry_module()
    assert set(mod.oracle_sql()) <= set(mod.queries())
    assert len(mod.queries()) >= 55
    assert len(mod.oracle_sql()) >= 45


FAST_SQL = ["insider_features", "sent_to_poi", "mail_parse", "term_stats", "tfidf",
            "cv_nb", "best_params", "nb_final", "scaled_features", "cv_svm", "final_logreg"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", FAST_SQL)
def test_query_matches_duckdb(spark, name):
    import sys
    sys.path.insert(0, os.path.join(ROOT, "tools"))
    from oracle_check import compare, duck

    mod = entry_module()
    r = compare(spark, duck(SF), name, mod.queries()[name], mod.oracle_sql()[name], SF)
    assert r["cols"] and r["tol"] and r["spark_rows"] == r["duck_rows"], r
