"""Every query of this library against its SQL in another engine: names, kinds of values, and values."""

import datetime
import math
from collections import Counter

import duckdb
import pytest

from leafmill.plans import catalogue
from leafmill.sources.scans import TABLES

SF = "/root/testdata/sf0.001"


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6) + 0.0
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, datetime.date):
        return x.isoformat()
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return x


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_matches_its_oracle(spark, oracle, name):
    got = catalogue.QUERIES[name](spark, SF)
    want = oracle.sql(catalogue.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    mine, theirs = rows_of(got.collect(), got.columns), rows_of(want.fetchall(), want.columns)
    assert mine == theirs, (list((mine - theirs).items())[:3], list((theirs - mine).items())[:3])
    assert sum(mine.values()) > 0 or name.startswith("rule_")


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_query_without_an_oracle_runs(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_every_table_is_used_and_names_are_unique():
    assert len(catalogue.QUERIES) >= 75 and set(catalogue.ORACLES) <= set(catalogue.QUERIES)


def test_the_entry_module_imports():
    import __spark_entry__ as e

    assert set(catalogue.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
