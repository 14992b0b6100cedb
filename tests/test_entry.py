"""The registered queries."""

import inspect

import __spark_entry__ as entry
from tidewatch.workload import queries as tidewatch_queries
from tests.conftest import SF


def test_entry_runs(spark):
    out = entry.entry(spark)
    assert out.count() == 1000 and "value_lag_24" in out.columns


def test_every_oracle_has_a_query():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries)
    assert set(tidewatch_queries()) <= set(queries)
    unchecked = set(tidewatch_queries()) - set(oracles)
    assert unchecked == {
        "tr_cv_best", "tr_score", "tr_spread", "tr_importance", "tr_perm", "job_train", "job_retrain", "job_score", "st_score"
    }
    for run in queries.values():
        assert list(inspect.signature(run).parameters) == ["spark", "sf_dir"]


def test_queries_match_their_sql(spark):
    """A few cheap queries of each kind; tools/check_oracles.py compares all."""
    import duckdb

    from tools.check_oracles import TABLES, tidy

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in ("fe_features", "val_findings", "prof_numeric", "prof_gaps", "tr_split", "dr_ks", "mon_report",
                 "reg_state", "exp_compare", "exp_fingerprint", "src_payload"):
        assert tidy(queries[name](spark, SF).toPandas()).equals(tidy(con.sql(oracles[name]).df())), name
