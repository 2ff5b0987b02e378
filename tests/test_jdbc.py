"""The database path, with a reader that runs the statements on Spark instead."""

from functools import reduce

import pytest

from rangeloom import load, load_landed, profile_spec


class Reader:
    def __init__(self, spark, sent):
        self.spark, self.sent, self.table = spark, sent, None

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        assert options["url"] == "jdbc:postgresql://db/sales" and options["user"] == "ann"
        return self

    def option(self, name, value):
        assert name == "dbtable"
        self.table = value
        return self

    def load(self):
        self.sent.append(self.table)
        return self.spark.sql(f"SELECT * FROM {self.table}")

    def jdbc(self, url, table, predicates, properties):
        self.sent.extend(predicates)
        parts = [self.spark.sql(f"SELECT * FROM {table} WHERE {p}") for p in predicates]
        return reduce(lambda a, b: a.unionAll(b), parts)

    def __getattr__(self, name):
        return getattr(self.spark.read, name)


class Session:
    def __init__(self, spark):
        self.spark, self.sent = spark, []

    @property
    def read(self):
        return Reader(self.spark, self.sent)

    def __getattr__(self, name):
        return getattr(self.spark, name)


@pytest.fixture
def database(spark):
    spark.range(1000).selectExpr(
        "if(id % 100 = 7, NULL, id) AS id", "if(id = 333, 'x', CAST(id AS STRING)) AS n", "id % 5 AS line"
    ).createOrReplaceTempView("sold")
    yield Session(spark)
    spark.catalog.dropTempView("sold")


SPEC = {
    "connection_string": "postgresql://ann:secret@db/sales",
    "query": "COPY (SELECT id, n FROM sold WHERE (line >= 0)) TO STDOUT (FORMAT binary)",
    "schema": [{"column_name": "id", "arrow_type": "Int64"}, {"column_name": "n", "arrow_type": "Int32"}],
}


def test_ranges(database):
    loaded = load(database, SPEC, 100, on_error="safe", parallelism=2)
    rows = loaded.rows.collect()
    assert len(rows) == 990 and [r.id for r in rows if r.n is None] == [333]
    assert loaded.plan.n_partitions == 10
    assert database.sent[1] == "id BETWEEN 0 AND 99" and len(database.sent) == 11
    assert [r.partition_index for r in loaded.failures.collect()] == [3]


def test_capped_and_split(database):
    spec = SPEC | {"query": "SELECT id, n, line FROM sold"}
    spec["schema"] = SPEC["schema"] + [{"column_name": "line", "arrow_type": "Int32"}]
    loaded = load(
        database, spec, 100, on_error="safe", null_keys="keep", parallelism=2,
        max_connections=6, split_by="line", splits=2,
    )
    assert loaded.rows.count() == 1000 and loaded.rows.where("n IS NULL").count() == 1
    assert [r.partition_index for r in loaded.failures.collect()] == [3]
    # The cap leaves the statements as they are: ten ranges and the NULL keys, in two parts each.
    assert len({p for p in database.sent if "MOD(" in p}) == 2 * 11


@pytest.mark.parametrize("ordered", [False, True])
def test_null_partition(database, ordered):
    loaded = load(database, SPEC, 100, on_error="null_partition", parallelism=2, ordered=ordered)
    rows = loaded.rows.collect()
    assert len(rows) == 900 - 9 + 100 and sum(r.id is None for r in rows) == 100
    assert all(not 300 <= r.id < 400 for r in rows if r.id is not None)


def test_empty(database):
    spec = SPEC | {"query": "SELECT id, n FROM sold WHERE id < 0"}
    loaded = load(database, spec, parallelism=2)
    assert loaded.rows.count() == 0 and loaded.plan is None
    assert load_landed(database, spec, "/nowhere", parallelism=2).rows.columns == ["id", "n"]


def test_landed(database, tmp_path):
    loaded = load_landed(database, SPEC, str(tmp_path), 250, parallelism=2)
    line = loaded.failures.first()
    assert (line.partition_index, line.lo, line.hi) == (1, 250, 499) and line.first_error == "column 'n' is not Int32, first at id 333"
    rows = loaded.rows.collect()
    assert len(rows) == 990 - 248 + 250
    assert sum(r.id is None for r in rows) == 250


def test_landed_from_the_session(spark, database, tmp_path):
    spec = SPEC | {"connection_string": "spark"}
    loaded = load_landed(spark, spec, str(tmp_path), 250, parallelism=2)
    assert [r.partition_index for r in loaded.failures.collect()] == [1]
    assert loaded.rows.count() == 990 - 248 + 250


def test_profile(database):
    assert profile_spec(database, SPEC, sample_rows=1000) == {"id": 10, "n": 1}
    assert database.sent[-1].endswith("LIMIT 1000) AS sample")


def test_landing_goes_on_after_growth(spark, tmp_path):
    def spec(n):
        return SPEC | {"connection_string": "spark", "query": f"SELECT id, CAST(id AS STRING) AS n FROM range({n})"}

    def grown(n):
        return SPEC | {"connection_string": "spark", "query": "SELECT id, n FROM growing"}

    spark.range(100).selectExpr("id", "CAST(id AS STRING) AS n").createOrReplaceTempView("growing")
    first = load_landed(spark, grown(100), str(tmp_path), 10, parallelism=2)
    spark.range(200).selectExpr("id", "CAST(id AS STRING) AS n").createOrReplaceTempView("growing")
    second = load_landed(spark, grown(200), str(tmp_path), 10, parallelism=2)
    wider = load_landed(spark, grown(200), str(tmp_path), 30, parallelism=2)
    other = load_landed(spark, spec(50), str(tmp_path), 10, parallelism=2)
    assert [x.rows.count() for x in (first, second, wider, other)] == [100, 200, 200, 50]
    assert [x.rows.distinct().count() for x in (first, second, wider, other)] == [100, 200, 200, 50]
    assert all(x.failures.count() == 0 for x in (first, second, wider, other))


def test_a_failed_slice_is_cut_down_to_its_range(spark, tmp_path):
    spark.range(100).selectExpr("id", "if(id = 57, 'x', CAST(id AS STRING)) AS n").createOrReplaceTempView("hurt")
    spec = SPEC | {"connection_string": "spark", "query": "SELECT id, n FROM hurt"}
    healed = load_landed(spark, spec, str(tmp_path), 5, parallelism=2, max_slices=4, with_index=True, ordered=True)
    rows = healed.rows.collect()
    assert [tuple(r) for r in rows if r.id is None] == [(11, None, None)] * 5 and len(rows) == 100
    assert [r.partition_index for r in rows] == [i // 5 for i in range(100)]
    assert [tuple(r)[:5] for r in healed.failures.collect()] == [(11, 55, 59, 5, 1)]
    safe = load(spark, spec, 5, parallelism=2, on_error="safe", landing=str(tmp_path))
    assert safe.rows.where("n IS NULL").count() == 1 and safe.rows.count() == 100
    assert [r.partition_index for r in safe.failures.collect()] == [11]
    with pytest.raises(RuntimeError, match="is not Int32"):
        load(spark, spec, 5, parallelism=2, landing=str(tmp_path))
