import duckdb
import pytest
from propweave import catalogue

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{D}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, D)
    want = duck.sql(catalogue.oracle_sql()[name])
    columns = sorted(df.columns)
    assert sorted(want.columns) == columns
    key = lambda rows: sorted(rows, key=repr)
    ours = key([tuple(r[c] for c in columns) for r in df.collect()])
    at = [want.columns.index(c) for c in columns]
    assert ours == key([tuple(r[i] for i in at) for r in want.fetchall()])


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_others_give_rows(spark, name):
    assert catalogue.queries()[name](spark, D).count() > 0
