"""Every registered query against its DuckDB oracle at sf0.001 (driver-style compare)."""

from __future__ import annotations

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
SF_ROWS = "/root/testdata/sf0.01"
TABLES = ("events", "conversations")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("testdata missing")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert "did_treatment_win" in df.columns
    assert df.count() > 0


def test_every_query_has_an_oracle():
    missing = sorted(set(E.queries()) - set(E.oracle_sql()) - set(E.LLM_QUERIES))
    assert missing == []


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.LLM_QUERIES)))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _digest(srows, df.columns) == _digest(orows, ocols)
    # The smallest data may rightly have no row for a report; the next ones must. Only the gate over raw assignments may
    # let nothing pass at any size: the feed repeats them on purpose.
    assert srows or name == "gated_results" or E.queries()[name](spark, SF_ROWS).head(1)
