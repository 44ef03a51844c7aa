"""Every query of this package with an SQL form, on the small tables and on edge rows."""

import os

import duckdb
import pytest

from airspark.llm import oracle_sql, queries

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "conversations")


def rows(cursor):
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=str)


def own(df):
    names = sorted(df.columns)
    return names, sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = own(queries.QUERIES[name](spark, SF))
    assert got == rows(con.execute(queries.ORACLE[name])) and got[1]


def test_conversations_with_odd_rows(spark, tmp_path):
    data = [(None, 0, "user", "Hi."), (None, None, None, None), (1, None, "system", "Be."), (1, 3, "user", "A"), (1, 3, "user", "A"),
            (1, 3, "assistant", "B!"), (1, 9, "ux", "\t"), (2, 0, "", "x."), (2, 1, "User", "É?"), (2, 2, "system", "é  "),
            (3, 5, "tool", "end\x1c"), (3, 4, "assistant", "#.\n")]
    data += [(c, t, r, x) for c in range(10, 60) for t, (r, x) in enumerate([("system", "S."), ("user", "Q?"), ("assistant", "A."), ("user", "Q?")])]
    spark.createDataFrame(data, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert own(queries.op11_conversation_repair(spark, str(tmp_path))) == rows(con.execute(oracle_sql.CONVERSATIONS))


def test_sharding_with_odd_rows(spark, tmp_path):
    data = [(None, None), (None, "x"), (1, ""), (1, "ü"), (1, "ü"), (-5, "line\nline"), *((i, "t" * i) for i in range(100, 160))]
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert own(queries.op13_sharding(spark, str(tmp_path))) == rows(con.execute(oracle_sql.sharding()))
