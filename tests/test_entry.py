import duckdb
import pytest

import __spark_entry__

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
OWN = [n for n in __spark_entry__.oracle_sql() if not n.startswith("op") and n != "pipeline"]


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object).where(lambda x: x.notna(), None)
    return sorted(tuple("" if v is None else f"{v:.7f}" if isinstance(v, float) else str(v) for v in r) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", OWN)
def test_query_equals_its_sql(spark, sf, duck, name):
    got, want = __spark_entry__.queries()[name](spark, sf).toPandas(), duck.execute(__spark_entry__.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
