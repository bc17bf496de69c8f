"""The driver contract, and every query with SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from strandloom.plans import catalog, table

SF = "/root/testdata/sf0.001"


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
def test_entry_runs(spark):
    assert entry.entry(spark).count() == 27


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
@pytest.mark.parametrize("part", catalog._PARTS, ids=lambda p: p.__name__.rpartition(".")[2])
def test_queries_agree_with_sql(spark, part):
    import duckdb

    # the line key of the table queries is unique from this size on
    sf = SF.replace("0.001", "0.01") if part is table else SF
    con = duckdb.connect()
    for t in os.listdir(sf):
        con.execute(f"CREATE VIEW {t.partition('.')[0]} AS SELECT * FROM '{sf}/{t}'")

    def shown(v):
        return f"{v:.5g}" if isinstance(v, float) else str(v)

    for name, (query, sql) in part.QUERIES.items():
        if sql:
            df = query(spark, sf)
            got = sorted(tuple(shown(r[c]) for c in sorted(df.columns)) for r in df.collect())
            cur = con.execute(sql)
            names = [x[0] for x in cur.description]
            at = [names.index(c) for c in sorted(df.columns)]
            assert got == sorted(tuple(shown(r[i]) for i in at) for r in cur.fetchall()), name
