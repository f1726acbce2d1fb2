"""Every query of the catalog that SQL can express, held against that SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

from cantor.operators import corpus
from cantor.plans.reader_catalog import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canonical(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    found = QUERIES[name](spark, sf_dir)
    wanted = duck.execute(ORACLES[name])
    names = [d[0] for d in wanted.description]
    assert sorted(found.columns) == sorted(names)
    assert canonical([tuple(r) for r in found.collect()], found.columns) == canonical(wanted.fetchall(), names)


def test_unit_tokens_of_empty_and_repeated_lines(spark):
    docs = spark.createDataFrame([(1, "a b\n\n!\r\na"), (2, None), (3, "")], "doc_id long, text string")
    units = corpus.token_ranges(corpus.spoken_units(docs, "doc_id"), "doc_id", "ordinal")
    found = corpus.unit_tokens(units.drop("text"), docs, "doc_id")
    assert sorted(map(tuple, found.select("doc_id", "token_index", "ordinal", "surface").collect())) == [(1, 0, 1, "a"), (1, 1, 1, "b"), (1, 2, 3, "a")]
    assert units.filter(F.col("token_end") == F.col("token_start")).count() == 1
