import glob
import os
import subprocess
import sys

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rangeloom import load, to_arrow, to_pandas
from rangeloom.functions.types import struct_of
from rangeloom.operators.land import land_ranges
from rangeloom.operators.sinks import create_table, insert_select, write_batches
from rangeloom.plans.ranges import RangePlan
from rangeloom.plans.session import load_session
from rangeloom.sources.synth import DECLARED_COLUMNS, synth_table
from rangeloom.streaming.batches import rebatch, stream_batches

TEN = struct_of(DECLARED_COLUMNS)


@pytest.fixture
def spec_file(tmp_path, folder):
    path = tmp_path / "spec.yaml"
    path.write_text(
        "connection_string: spark\nbatch_size: 4000\nquery: >\n"
        f"  COPY (SELECT o_orderkey AS id, o_orderdate, o_totalprice FROM parquet.`{folder}/orders.parquet`)\n"
        "  TO STDOUT (FORMAT binary)\nschema:\n- {column_name: id, arrow_type: Int64}\n"
        "- {column_name: day, arrow_type: Date32}\n- {column_name: price, arrow_type: Float32}\n"
    )
    return str(path)


def test_load_of_a_spec_file(spark, spec_file):
    loaded = load(spark, spec_file, 1000)
    assert loaded.rows.schema.simpleString() == "struct<id:bigint,day:date,price:float>"
    assert loaded.plan.n_partitions == 15 and loaded.rows.count() == 15_000
    sizes = [b.num_rows for b in loaded.batches()]
    assert sum(sizes) == 15_000 and max(sizes) == 4000


def test_arrow_and_pandas(spark, spec_file):
    rows = load(spark, spec_file, ordered=True).rows
    table = to_arrow(rows)
    assert table.num_rows == 15_000 and table.schema.field("price").type == pa.float32()
    before = spark.conf.get("spark.sql.execution.arrow.pyspark.enabled")
    assert to_pandas(rows)["id"].tolist() == to_pandas(table)["id"].tolist() == list(range(15_000))
    assert spark.conf.get("spark.sql.execution.arrow.pyspark.enabled") == before


def test_tables(spark):
    create_table(spark, "generated", TEN)
    assert spark.table("generated").count() == 0
    assert spark.table("generated").schema.simpleString() == TEN.simpleString()
    insert_select(synth_table(spark, 500), "generated")
    insert_select(synth_table(spark, 500), "generated")
    assert spark.table("generated").count() == 1000
    create_table(spark, "generated", TEN)
    assert spark.table("generated").count() == 0
    spark.sql("DROP TABLE generated")


def test_batch_files(spark, tmp_path):
    path = str(tmp_path / "out")
    write_batches(synth_table(spark, 1000).coalesce(1), path, 300)
    sizes = sorted(pq.ParquetFile(f).metadata.num_rows for f in glob.glob(path + "/*.parquet"))
    assert sizes == [100, 300, 300, 300]


@pytest.mark.parametrize("sizes", [[], [0], [5], [3, 3, 3], [10, 0, 1], [25]])
def test_rebatch(sizes):
    schema = pa.schema([("n", pa.int64())])
    batches = [pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64())], schema=schema) for n in sizes]
    out = list(rebatch(batches, 5))
    assert [b.num_rows for b in out] == [5] * (sum(sizes) // 5) + ([sum(sizes) % 5] if sum(sizes) % 5 else [])
    values = [v for b in out for v in b.column(0).to_pylist()]
    assert values == [v for b in batches for v in b.column(0).to_pylist()]


def test_stream_batches(spark):
    df = synth_table(spark, 1000).repartition(3)
    batches = list(stream_batches(df, 150))
    assert max(b.num_rows for b in batches) == 150
    assert sorted(v for b in batches for v in b.column("id").to_pylist()) == list(range(1, 1001))


def test_landing_heals_and_resumes(spark, tmp_path):
    schema = struct_of([("id", "Int64"), ("n", "Int32")])
    plan = RangePlan(0, 99, 10)
    calls = []
    broken = {3, 7}

    def read_range(lo, hi):
        calls.append(lo)
        part = spark.range(lo, hi + 1).selectExpr("id", "CAST(id AS STRING) AS n")
        if lo // 10 in broken:
            lost = F.when(F.col("id") == lo + 5, F.raise_error(F.lit("connection lost"))).otherwise(F.col("n"))
            part = part.withColumn("n", lost)
        return part

    loaded = land_ranges(spark, read_range, plan, schema, str(tmp_path))
    lines = sorted(loaded.failures.collect())
    assert [(r.partition_index, r.lo, r.hi, r.expected_rows) for r in lines] == [(3, 30, 39, 10), (7, 70, 79, 10)]
    assert all("connection lost" in r.first_error and r.n_bad is None for r in lines)
    ids = [r.id for r in loaded.rows.collect()]
    assert ids.count(None) == 20 and len(ids) == 100
    assert sorted(i for i in ids if i is not None) == [i for i in range(100) if i // 10 not in broken]

    calls.clear()
    broken.clear()
    again = land_ranges(spark, read_range, plan, schema, str(tmp_path))
    assert sorted(calls) == [30, 70]
    assert again.failures.count() == 0 and again.rows.where("id IS NOT NULL").count() == 100


def test_landing_merges_fine_plans(spark, tmp_path):
    schema = struct_of([("id", "Int64")])
    loaded = land_ranges(
        spark, lambda lo, hi: spark.range(lo, hi + 1).toDF("id"), RangePlan(0, 999, 3), schema,
        str(tmp_path), max_slices=4,
    )
    assert sorted(r.id for r in loaded.rows.collect()) == list(range(1000))
    assert len(glob.glob(str(tmp_path) + "/load-*/__piece=*")) == 4


def test_session_settings(spark):
    again = load_session("x", spark__sql__shuffle__partitions="8")
    assert again.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_workers_need_no_installed_package(tmp_path, folder):
    """The package reaches the executors with the functions that use it."""
    script = f"""
import sys
sys.path.insert(0, {os.getcwd()!r})
from pyspark.sql import SparkSession
from rangeloom.queries import QUERIES
settings = {{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}}
spark = SparkSession.builder.master("local[2]").config(map=settings).getOrCreate()
print("rows", QUERIES["dump_roundtrip"](spark, {folder!r}).count())
"""
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=120
    )
    assert "rows 15000" in done.stdout
