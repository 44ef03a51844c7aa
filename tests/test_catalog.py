"""Every registered query has an oracle or is knowingly rows-only; oracle parity at sf0.001."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "scripts")]

SF = "/root/testdata/sf0.001"
ROWS_ONLY = {"ml_forest", "ml_boosted", "ml_compare", "ml_refit", "ml_importance", "ml_score"}


def catalog():
    """The library's own queries (the training-data operators are tested in their own folder)."""
    from airspark.plans.catalog import load_all
    return load_all()


def test_every_query_has_oracle_or_is_rows_only():
    q, o = catalog()
    assert set(o) <= set(q)
    assert set(q) - set(o) == ROWS_ONLY


def test_entry_holds_the_catalog():
    import __spark_entry__ as E
    q, o = catalog()
    assert set(q) <= set(E.queries()) and set(o) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
@pytest.mark.parametrize("name", sorted(catalog()[1]))
def test_oracle_parity_sf0001(spark, name, monkeypatch):
    import __spark_entry__ as E
    from airspark.plans import ml as M
    # What SQL can say of the registry does not hang on the size of its models (their sizes: test_models.py).
    monkeypatch.setitem(M.FOREST_PARAMS, "numTrees", 3)
    monkeypatch.setitem(M.BOOSTED_PARAMS, "rounds", 3)
    from oracle_check import TABLES, rows_of
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = rows_of(E.queries()[name](spark, SF).toPandas())
    exp = rows_of(con.execute(E.oracle_sql()[name]).df())
    assert got[0] == exp[0]
    assert got[1] == exp[1]


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert len(df.columns) == 31 and df.count() > 0
