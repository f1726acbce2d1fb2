"""The operators' queries that SQL can express, held against that SQL."""

import duckdb
import pytest

from cantor.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    wanted = con.execute(ORACLES[name])
    names = sorted(d[0] for d in wanted.description)
    rows = wanted.fetchall()
    at = [[d[0] for d in wanted.description].index(n) for n in names]
    found = QUERIES[name](spark, sf_dir)
    assert sorted(found.columns) == names
    assert sorted(map(repr, (tuple(r[i] for i in at) for r in rows))) == sorted(map(repr, map(tuple, found.select(*names).collect())))
