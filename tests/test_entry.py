import collections
from pathlib import Path

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry

ORACLE = entry.oracle_sql()


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(r[i] for i in order) for r in data)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", [n for n in entry.queries()])
def test_query_matches_its_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    got = df.collect()
    if name not in ORACLE:
        assert got
        return
    want = db.execute(ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, got) == rows(names, want.fetchall())


@pytest.mark.parametrize("name", [n for n in entry.queries() if n.startswith("stream_")])
def test_streams_read_folders_of_part_files(spark, db, name, tmp_path):
    spark.read.parquet(f"{SF}/events.parquet").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    df = entry.queries()[name](spark, str(tmp_path))
    want = db.execute(ORACLE[name])
    assert rows(df.columns, df.collect()) == rows([d[0] for d in want.description], want.fetchall())


def test_a_missing_table_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        entry.queries()["stream_fare_totals"](spark, str(tmp_path)).collect()


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(entry.queries())
