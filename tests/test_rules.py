"""Rules that hold across modules: paths, tags, zones, overflow, streaming."""

from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rangeloom.functions.epoch import days_to_date, micros_to_timestamp
from rangeloom.functions.skew import ROW_TAG, with_row_tag
from rangeloom.functions.types import struct_of
from rangeloom.operators.bind import positional_bind
from rangeloom.operators.load import load_table
from rangeloom.plans.session import scratch_path, shared_folder
from rangeloom.sources import dump, store
from rangeloom.sources.dump_codec import DumpError
from rangeloom.streaming import batches

ONE = struct_of([("id", "Int64")])


def test_paths_are_sparks(spark, tmp_path):
    assert store.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    with pytest.raises(ValueError, match="which file system"):
        store.locate("/data/x")
    assert store.locate(f"file:{tmp_path}")[1] == str(tmp_path)
    (tmp_path / "full").write_bytes(b"x")
    (tmp_path / "cut").write_bytes(b"")
    assert store.empty_files(spark, str(tmp_path)) == [f"file:{tmp_path}/cut"]
    assert store.exists(spark, f"{tmp_path}/full")
    store.delete(spark, str(tmp_path))
    assert not tmp_path.exists()


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "spark://host:7077", "yarn"])
def test_clusters_need_a_shared_folder(master):
    nothing = SimpleNamespace(get=lambda key, default=None: default)
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(SimpleNamespace(conf=nothing, sparkContext=context))


def test_tags_differ_between_rows_from_one_place(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet").limit(300).select("o_orderkey")
    many = spark.range(50)
    for fanned in (
        orders.crossJoin(many).select("o_orderkey"),
        orders.withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(50)))).select("o_orderkey"),
    ):
        assert with_row_tag(fanned).select(ROW_TAG).distinct().count() == 300 * 50


def test_instants_do_not_follow_the_session_zone(spark):
    kinds = [("at", "Timestamp(Nanosecond, None)"), ("on", "Date32"), ("text", "Utf8")]
    instants = spark.sql("SELECT timestamp_micros(1700000000000000) AS a, timestamp_micros(-1) AS b, timestamp_micros(0) AS c")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        found = set()
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            row = positional_bind(instants, struct_of(kinds)).selectExpr("CAST(at AS STRING)", "CAST(on AS STRING)", "text").first()
            found.add(tuple(row))
        assert found == {("2023-11-14 22:13:20", "1969-12-31", "1970-01-01 00:00:00")}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("value, fits", [("1e300D", False), ("1e30D", True), ("double('infinity')", True), ("double('nan')", True)])
def test_finite_values_do_not_become_infinite(spark, value, fits):
    df = spark.sql(f"SELECT {value} AS x")
    kind = struct_of([("x", "Float32")])
    assert (positional_bind(df, kind, "safe").first()[0] is not None) == fits
    if not fits:
        with pytest.raises(Exception, match="is not Float32"):
            positional_bind(df, kind).collect()


def test_safe_epoch_never_throws(spark):
    df = spark.sql("SELECT 2147483646 AS d, 9223372036854775806L AS m")
    assert tuple(df.select(days_to_date(F.col("d"), safe=True), micros_to_timestamp(F.col("m"), safe=True)).first()) == (None, None)


def test_rule_is_honoured_by_every_policy(spark):
    source = spark.range(100)
    with pytest.raises(Exception, match="refused by rule"):
        load_table(source, ONE, 10, rule="id = 50").rows.collect()
    safe = load_table(source, ONE, 10, rule="id = 50", on_error="safe")
    assert safe.rows.count() == 100 and [r.partition_index for r in safe.failures.collect()] == [5]


def test_null_keys_heal_to_as_many_rows(spark):
    rows = spark.createDataFrame([(1, "1"), (2, "2"), (3, "3"), (None, "bad")], "id bigint, n string")
    schema = struct_of([("id", "Int64"), ("n", "Int32")])
    healed = load_table(rows, schema, 10, on_error="null_partition", null_keys="keep")
    assert sorted(map(str, healed.rows.collect())) == sorted(
        ["Row(id=1, n=1)", "Row(id=2, n=2)", "Row(id=3, n=3)", "Row(id=None, n=None)"]
    )
    line = healed.failures.first()
    assert (line.partition_index, line.expected_rows, line.first_error) == (None, 1, "column 'n' is not Int32, at a NULL key")
    only = load_table(rows.where("id IS NULL"), schema, 10, on_error="null_partition", null_keys="keep")
    assert only.rows.count() == 1 and only.plan is None and only.failures.count() == 1


def test_streaming_takes_runs_not_partitions(spark, monkeypatch):
    monkeypatch.setattr(batches, "AHEAD_BYTES", 20_000)
    df = spark.range(0, 20_000, 1, 2)
    found = list(batches.stream_batches(df, 1000))
    assert [b.num_rows for b in found] == [1000] * 20
    assert pa.Table.from_batches(found).column("id").to_pylist() == list(range(20_000))


def test_dumps_end_right(spark):
    target = scratch_path(spark, "dumps")
    dump.write_dumps(spark.range(10).coalesce(1), target, ONE)
    with pytest.raises(FileExistsError):
        dump.write_dumps(spark.range(5), target, ONE)
    bare = target.removeprefix("file:")
    open(f"{bare}/part-00007.bin", "wb").close()
    with pytest.raises(DumpError, match="no bytes at all"):
        dump.decode_files(spark, target, ONE)
    status = {r.path.rsplit("/", 1)[1]: (r.rows, r.error) for r in dump.file_status(spark, target, ONE).collect()}
    assert status == {"part-00000.bin": (10, None), "part-00007.bin": (0, "no bytes at all")}
    nobody = spark.createDataFrame([], "path string, expected_rows bigint")
    with pytest.raises(DumpError, match="no expected number of rows"):
        dump.heal_files(spark, target, ONE, nobody)
