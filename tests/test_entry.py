import __spark_entry__ as e
import pytest

from skyloom.plans import queries as sky
from skyloom.plans import survey_queries as surveys

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_entry_has_rows(spark):
    assert e.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


#: association_loop is the same machine as the association queries, over more steps; association_resumed stores them, too.
NAMES = sorted(set(sky.ORACLE_SQL | surveys.ORACLE_SQL) - {"association_loop"})


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_sql(spark, duck, name):
    """Every SQL query, every row, every value."""
    mine = e.queries()[name](spark, SF)
    theirs = duck.sql(e.oracle_sql()[name])
    columns = sorted(mine.columns)
    assert columns == sorted(theirs.columns)
    key = lambda row: tuple(str(v) for v in row)
    assert sorted(map(key, mine.select(*columns).collect())) == sorted(map(key, theirs.select(*columns).fetchall()))
