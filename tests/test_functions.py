import datetime as dt

import pytest
from pyspark.sql import functions as F

from rangeloom.functions import epoch
from rangeloom.functions.casts import sql_text, text_is_valid
from rangeloom.functions.types import struct_of
from rangeloom.operators.bind import positional_bind

INF = 2**63 - 1


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield
    spark.conf.set("spark.sql.session.timeZone", before)


def test_epoch(spark, zone):
    df = spark.createDataFrame([(0, 0), (-1, -1), (86_400_000_001, 366), (None, None)], "us bigint, d int")
    rows = df.select(
        epoch.micros_to_timestamp(F.col("us")).alias("t"), epoch.days_to_date(F.col("d")).alias("day")
    )
    found = [tuple(r) for r in rows.collect()]
    assert found == [
        (dt.datetime(2000, 1, 1), dt.date(2000, 1, 1)),
        (dt.datetime(1999, 12, 31, 23, 59, 59, 999999), dt.date(1999, 12, 31)),
        (dt.datetime(2000, 1, 2, 0, 0, 0, 1), dt.date(2001, 1, 1)),
        (None, None),
    ]
    back = rows.select(epoch.timestamp_to_micros(F.col("t")), epoch.date_to_days(F.col("day")))
    assert [tuple(r) for r in back.collect()] == [tuple(r) for r in df.collect()]


def test_spring_forward_hour_survives(spark, zone):
    ts = "timestamp_ntz'2024-03-10 02:30:00'"
    df = spark.sql(f"SELECT {ts} AS t").select("t", epoch.timestamp_to_micros(F.col("t")).alias("us"))
    assert df.where(epoch.micros_to_timestamp(F.col("us")) == F.col("t")).count() == 1


def test_infinities(spark):
    df = spark.createDataFrame([(INF, 2**31 - 1), (-INF - 1, -(2**31))], "us bigint, d int")
    safe = df.select(epoch.micros_to_timestamp(F.col("us"), True), epoch.days_to_date(F.col("d"), True))
    assert [tuple(r) for r in safe.collect()] == [(None, None)] * 2
    for strict in (epoch.micros_to_timestamp(F.col("us")), epoch.days_to_date(F.col("d"))):
        with pytest.raises(Exception, match="infinite"):
            df.select(strict).collect()


def test_byte_to_boolean(spark):
    df = spark.createDataFrame([(0,), (1,), (-1,), (None,)], "b tinyint")
    assert [r[0] for r in df.select(epoch.byte_to_boolean(F.col("b"))).collect()] == [False, True, True, None]


def test_utf8(spark):
    df = spark.createDataFrame([(b"caf\xc3\xa9",), (b"caf\xc3",), (b"",), (None,)], "raw binary")
    assert [r[0] for r in df.select(text_is_valid(F.col("raw"))).collect()] == [True, False, True, None]


def test_binary_to_text(spark, ansi):
    df = spark.createDataFrame([(b"caf\xc3\xa9",), (b"caf\xc3",)], "raw binary")
    schema = struct_of([("text", "Utf8")])
    assert [r.text for r in positional_bind(df, schema, "safe").collect()] == ["café", None]
    with pytest.raises(Exception, match="column 'text': '636166C3' is not Utf8"):
        positional_bind(df, schema).collect()
    text = df.select(F.col("raw").cast("string"))
    checked = positional_bind(text, schema, "safe", check_utf8=True)
    assert [r.text for r in checked.collect()] == ["café", None]


def test_strict_fails_whatever_the_session_says(spark, ansi):
    df = spark.createDataFrame([("1",), ("x",)], "a string")
    schema = struct_of([("n", "Int32")])
    assert [r.n for r in positional_bind(df, schema, "safe").collect()] == [1, None]
    with pytest.raises(Exception, match="column 'n': 'x' is not Int32"):
        positional_bind(df, schema).collect()


def test_number_casts(spark, ansi):
    df = spark.sql(
        "SELECT * FROM VALUES (2.5D, 2.5, 3000000000L, 1.1D), (3.5D, 3.5, 7L, 1e300D),"
        " (-2.5D, -2.5, NULL, NULL) AS t(a, b, c, d)"
    )
    schema = struct_of([("a", "Int64"), ("b", "Int32"), ("c", "Int32"), ("d", "Float32")])
    rows = [tuple(r) for r in positional_bind(df, schema, "safe").collect()]
    assert [r[:3] for r in rows] == [(2, 3, None), (4, 4, 7), (-2, -3, None)]
    assert rows[0][3] == pytest.approx(1.1, rel=1e-6)


def test_column_count_must_match(spark):
    with pytest.raises(ValueError, match="1 columns, the schema 2"):
        positional_bind(spark.range(1), struct_of([("a", "Int64"), ("b", "Int64")]))


def test_odd_names(spark):
    df = spark.createDataFrame([("1",), ("it's",)], "`we``ird.name` string")
    schema = struct_of([("o'dd` na.me", "Int32")])
    assert positional_bind(df, schema, "safe").columns == ["o'dd` na.me"]
    with pytest.raises(Exception, match="is not Int32"):
        positional_bind(df, schema).collect()
    assert spark.sql(f"SELECT {sql_text(chr(92) + chr(39) + 'x')}").first()[0] == "\\'x"


def test_pass_through_keeps_pushdown(table, capsys):
    schema = struct_of([("k", "Int64"), ("name", "Utf8"), ("n", "Int32"), ("b", "Float64"), ("s", "Utf8")])
    positional_bind(table("customer"), schema).where("s = 'BUILDING'").select("k").explain()
    plan = capsys.readouterr().out
    assert "EqualTo(c_mktsegment,BUILDING)" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in plan
