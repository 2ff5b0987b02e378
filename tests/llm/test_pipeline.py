"""The registered queries and the pipeline on the small tables."""

import duckdb
import pytest

import corpus_pipeline
from rangeloom.llm.queries import ORACLES, QUERIES
from rangeloom.plans.session import scratch_path
from tests.conftest import TESTDATA
from tests.llm import brute


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{TESTDATA}/sf0.001/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    ours = QUERIES[name](spark, f"{TESTDATA}/sf0.001")
    kinds = {k[0]: k[1] for k in con.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    assert {f.name: KINDS[f.dataType.simpleString()] for f in ours.schema} == kinds
    columns = sorted(ours.columns)
    theirs = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, ours.select(*columns).collect()), key=repr) == sorted(theirs, key=repr)


def test_every_operator_is_registered():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}


def test_stages(spark, con):
    folder, docs = f"{TESTDATA}/sf0.001", spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    rows = {r[0]: r[1] for r in con.execute("SELECT doc_id, text FROM documents").fetchall()}
    kept = [rows.keys()]
    for name, stage in corpus_pipeline.STAGES[:3]:
        path = scratch_path(spark, "stage")
        stage(spark, docs, folder).write.parquet(path)
        columns = docs.columns
        docs = spark.read.parquet(path)
        assert docs.columns == columns, name
        kept.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    given = [(d, rows[d]) for d in kept[1]]
    assert all(any(c.isalpha() for c in rows[d] or "") for d in kept[1])
    assert kept[2] == {d for d, _, c in brute.near(given) if d == c}
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    assert kept[3] == {r[0] for r in brute.leaks([(d, rows[d]) for d in kept[2]], items) if not r[5]}
    mixed = corpus_pipeline.mix(spark, docs, folder)
    assert mixed.columns == docs.columns
    tokens = corpus_pipeline.write_token_files(spark, mixed, folder)
    assert tokens.count() == mixed.count()
