import importlib.util
import math
import os

import duckdb
import pytest

from tests.conftest import SMALL

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(HERE, "__spark_entry__.py"))
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def same(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(same(row[i]) for i in order) for row in rows), key=repr)


def test_every_sql_text_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    found = QUERIES[name](spark, SMALL)
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(found.columns) == sorted(names)
    assert sorted_rows(found.columns, found.collect()) == sorted_rows(names, cursor.fetchall())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
