import pytest

from rangeloom.functions.types import spark_type, struct_of
from rangeloom.plans.ranges import RangePlan
from rangeloom.plans.spec import LoadSpec, SpecError, as_spec, inner_query, jdbc_options
from rangeloom.sources import jdbc

URL = "postgresql://ann:s%40crt@db.example:5433/sales"
COLUMNS = [{"column_name": "id", "arrow_type": "Int64"}, {"column_name": "at", "arrow_type": "Date32"}]
GOOD = {"connection_string": URL, "query": "SELECT id, at FROM t", "schema": COLUMNS}


@pytest.mark.parametrize(
    "query, inner",
    [
        ("SELECT 1", "SELECT 1"),
        (" select a from t ; ", "select a from t"),
        ("COPY (SELECT f(x) FROM t WHERE g(y)) TO STDOUT (FORMAT binary)", "SELECT f(x) FROM t WHERE g(y)"),
        ("copy (SELECT a, (b) FROM (t))\n to stdout (format BINARY);", "SELECT a, (b) FROM (t)"),
        ("COPY (SELECT ')') TO STDOUT WITH (FORMAT binary)", "SELECT ')'"),
        ("WITH x AS (SELECT 1) SELECT * FROM x", "WITH x AS (SELECT 1) SELECT * FROM x"),
    ],
)
def test_envelope(query, inner):
    assert inner_query(query) == inner


@pytest.mark.parametrize("query", ["DROP TABLE t", "COPY t TO STDOUT (FORMAT binary)", "COPY (SELECT 1) TO STDOUT"])
def test_other_statements_are_refused(query):
    with pytest.raises(SpecError, match="neither a SELECT"):
        inner_query(query)


@pytest.mark.parametrize(
    "change, message",
    [
        ({"connection_string": ""}, "connection_string is empty"),
        ({"query": " "}, "query is empty"),
        ({"schema": []}, "schema has no columns"),
        ({"schema": [{"column_name": "id"}]}, "arrow_type"),
        ({"schema": [COLUMNS[0], COLUMNS[0]]}, "repeats a column name"),
        ({"batch_size": 0}, "batch_size"),
    ],
)
def test_validation(change, message):
    with pytest.raises(SpecError, match=message):
        LoadSpec.from_dict(GOOD | change)


def test_unsupported_type():
    with pytest.raises(ValueError, match="declared type 'Decimal'"):
        LoadSpec.from_dict(GOOD | {"schema": [{"column_name": "x", "arrow_type": "Decimal"}]})


def test_missing_field():
    with pytest.raises(SpecError, match="missing field: schema"):
        LoadSpec.from_dict({k: v for k, v in GOOD.items() if k != "schema"})


def test_yaml(tmp_path):
    path = tmp_path / "spec.yaml"
    path.write_text(
        f"connection_string: {URL}\nquery: >\n  COPY (SELECT id, at FROM t)\n  TO STDOUT (FORMAT binary)\n"
        "schema:\n- column_name: id\n  arrow_type: Int64\n- column_name: at\n"
        "  arrow_type: Timestamp(Nanosecond, None)\nbatch_size: 1000\n"
    )
    spec = as_spec(str(path))
    assert spec.select == "SELECT id, at FROM t"
    assert spec.schema == struct_of([("id", "Int64"), ("at", "Timestamp(Nanosecond, None)")])
    assert spec.batch_size == 1000
    assert LoadSpec.from_dict(GOOD).batch_size == 65_536
    path.write_text("- 1\n")
    with pytest.raises(SpecError, match="mapping"):
        as_spec(str(path))


def test_types():
    names = ["Int64", "Int32", "Float64", "Float32", "Utf8", "String", "Boolean",
             "Timestamp(Nanosecond, None)", "Date32"]
    kinds = ["bigint", "int", "double", "float", "string", "string", "boolean", "timestamp_ntz", "date"]
    assert [spark_type(n).simpleString() for n in names] == kinds
    assert all(f.nullable for f in struct_of([("a", "Int64")]))


def test_the_password_is_never_shown():
    spec = LoadSpec.from_dict(GOOD)
    assert "s%40crt" not in repr(spec) and "s@crt" not in str(spec)


def test_connection_strings():
    expected = {
        "url": "jdbc:postgresql://db.example:5433/sales",
        "driver": "org.postgresql.Driver",
        "user": "ann",
        "password": "s@crt",
    }
    assert jdbc_options(URL) == expected
    assert jdbc_options("host=db.example port=5433 dbname=sales user=ann password='s@crt'") == expected
    assert jdbc_options(URL + "?sslmode=require")["sslmode"] == "require"
    assert jdbc_options("jdbc:other:x") == {"url": "jdbc:other:x"}
    with pytest.raises(SpecError, match="connection_string is no URL"):
        jdbc_options("nonsense")


def test_jdbc_statements():
    spec = LoadSpec.from_dict(GOOD)
    assert jdbc.bounds_query(spec, "id") == (
        "(SELECT MIN(id) AS lo, MAX(id) AS hi FROM (SELECT id, at FROM t) AS sub) AS bounds"
    )
    plan = RangePlan(0, 99, 10)
    assert len(plan.predicates("id", 100)) == 10
    assert plan.predicates("id", 2) == ["id BETWEEN 0 AND 49", "id BETWEEN 50 AND 99"]
    assert plan.predicates("id", 1, keep_nulls=True) == ["id BETWEEN 0 AND 99", "id IS NULL"]


def test_predicates_split_rows(spark, table):
    orders = table("orders")
    plan = RangePlan(0, 14999, 7)
    parts = [orders.where(p).count() for p in plan.predicates("o_orderkey", 5, keep_nulls=True)]
    assert len(parts) == 6 and sum(parts) == orders.count() and parts[-1] == 0


@pytest.mark.parametrize("splits", [1, 3])
def test_predicates_split_one_key(spark, splits):
    rows = spark.range(300).selectExpr("if(id % 10 = 0, NULL, 5L) AS k", "if(id % 7 = 0, NULL, -id) AS other")
    plan = RangePlan(0, 9, 5)
    tests = plan.predicates("k", 100, True, "other", splits)
    assert len(tests) == 3 * splits
    parts = [rows.where(t).count() for t in tests]
    assert sum(parts) == 300 and max(parts) < 270 / splits + 45


def test_jdbc_reader_arguments(monkeypatch):
    calls = {}

    class Reader:
        def jdbc(self, url, table, predicates, properties):
            calls.update(url=url, table=table, predicates=predicates, properties=properties)

    class Session:
        read = Reader()

    jdbc.read_ranges(Session(), LoadSpec.from_dict(GOOD), RangePlan(0, 99, 1), "id", 4, keep_nulls=True)
    assert calls["url"] == "jdbc:postgresql://db.example:5433/sales"
    assert calls["table"] == "(SELECT id, at FROM t) AS sub"
    assert len(calls["predicates"]) == 4 and calls["predicates"][-1] == "id IS NULL"
    assert calls["properties"]["password"] == "s@crt" and "url" not in calls["properties"]
