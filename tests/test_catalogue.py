"""Every query against its SQL, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from changeflow.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def plain(df):
    def value(x):
        if x is None or x is pd.NA or x != x:
            return ""
        if hasattr(x, "tolist"):
            x = x.tolist()
        return str(x) if isinstance(x, pd.Timestamp) else x

    return sorted((tuple(map(value, r)) for r in df[sorted(df.columns)].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_equals_sql(spark, duck, data, name):
    ours, theirs = catalogue.QUERIES[name](spark, data).toPandas(), duck.execute(catalogue.ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert plain(ours) == plain(theirs)
    assert len(ours)


def test_all_queries_have_sql_or_a_reason(spark, data):
    assert set(catalogue.QUERIES) - set(catalogue.ORACLES) == {"fake_rows"}
    again = [catalogue.fake_rows(spark, data).toPandas() for _ in range(2)]
    assert again[0].astype(str).equals(again[1].astype(str))


@pytest.mark.parametrize(("name", "module", "operator"), [("keyset_rows", "scan", "page"), ("keyset_page", "scan", "page"), ("readback_topk", "namespace", "first_documents"), ("dlq_newest", "state", "newest")])
def test_limits_are_the_operators(spark, data, monkeypatch, name, module, operator):
    """What these queries check is the repository's operator, not one of their own."""
    owner, calls = getattr(catalogue, module), []
    real = getattr(owner, operator)
    monkeypatch.setattr(owner, operator, lambda *a, **k: calls.append(operator) or real(*a, **k))
    assert catalogue.QUERIES[name](spark, data).count() and calls == [operator]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
