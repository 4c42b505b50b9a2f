"""Every registered query equals its DuckDB oracle (exact multiset, no rounding) on the
smallest scale; scripts/check_oracle.py runs the same at sf0.01."""

import collections
import importlib.util
import os

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

import __spark_entry__ as E

from tidemark.plans.oracle import ORACLE
from tidemark.plans.registry import QUERIES

_spec = importlib.util.spec_from_file_location("check_oracle", os.path.join(ROOT, "scripts", "check_oracle.py"))
CO = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(CO)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in CO.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["dataCotacao", "indicador", "ticker"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows, scols = df.collect(), df.columns
    rel = duck.sql(E.oracle_sql()[name])
    drows, dcols = rel.fetchall(), rel.columns
    assert sorted(scols) == sorted(dcols)
    sfam = {f.name: CO.family_spark(f.dataType.simpleString()) for f in df.schema.fields}
    dfam = {c: CO.family_duck(str(t)) for c, t in zip(dcols, rel.types)}
    assert sfam == dfam
    order = sorted(scols)
    a = collections.Counter(tuple(CO.norm(r[scols.index(c)]) for c in order) for r in srows)
    b = collections.Counter(tuple(CO.norm(r[dcols.index(c)]) for c in order) for r in drows)
    assert len(srows) == len(drows)
    assert a == b
