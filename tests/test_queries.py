"""Every registered query against DuckDB on the same tables."""

import collections
import math

import duckdb
import pytest

import __spark_entry__ as contract
from rangeloom.queries import ORACLES, QUERIES
from tests.conftest import TESTDATA

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(normal(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def tables(request):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{TESTDATA}/{request.param}/{name}.parquet')"
        )
    return f"{TESTDATA}/{request.param}", con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, tables, name):
    folder, con = tables
    ours = QUERIES[name](spark, folder)
    kinds = con.execute(f"DESCRIBE {ORACLES[name]}").fetchall()
    assert {f.name: KINDS[f.dataType.simpleString()] for f in ours.schema} == {k[0]: k[1] for k in kinds}
    theirs = con.execute(ORACLES[name])
    expected = bag([c[0] for c in theirs.description], theirs.fetchall())
    found = bag(ours.columns, [tuple(r) for r in ours.collect()])
    assert found == expected


def test_row_like_texts_are_not_broadcast(spark, tmp_path):
    """The spans of dumps are few and small, the texts decoded from them are not."""
    rows = [(k, "word " * (k % 50)) for k in range(60)] + [(61, None), (None, "no key"), (4, "again")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["dump_row_like_texts"](spark, str(tmp_path))
    lines = found.collect()
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert len(lines) == 60 - 1 + 1 + 4 and [r.n_chars for r in lines if r.doc_id == 7] == [35]


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys() and ORACLES.keys() <= contract.oracle_sql().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns[0] == "partition_index"
    assert rows.count() == spark.read.parquet(f"{TESTDATA}/sf0.001/orders.parquet").count()
