"""Batches to a consumer: their order, when they come, and what becomes of errors."""

import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rangeloom.streaming import batches
from rangeloom.streaming.batches import stream_batches


@pytest.mark.parametrize("prefetch", [True, False])
def test_partitions_come_in_order(spark, prefetch):
    df = spark.range(0, 5_000, 1, 7).where("id % 1000 <> 3").selectExpr("id", "repeat('x', CAST(id % 50 AS INT)) AS t")
    found = list(stream_batches(df, 300, prefetch))
    assert max(b.num_rows for b in found) == 300
    assert pa.Table.from_batches(found).column("id").to_pylist() == [k for k in range(5_000) if k % 1000 != 3]


def test_a_sorted_frame_streams_without_a_second_exchange(spark, capsys):
    df = spark.range(0, 2_000, 1, 4).withColumn("k", F.pmod(F.hash("id"), F.lit(10_000))).orderBy("k", "id")
    batches.write_batches_by_part(df, "file:/tmp/nowhere", 100).explain()
    assert capsys.readouterr().out.count("Exchange") == 1
    keys = [k for b in stream_batches(df, 100) for k in b.column("k").to_pylist()]
    assert keys == sorted(keys) and len(keys) == 2_000


def test_first_batches_come_while_later_ones_are_computed(spark):
    def slow(parts):
        from pyspark import TaskContext

        if TaskContext.get().partitionId() == 15:
            time.sleep(4)
        yield from parts

    df = spark.range(0, 1_600, 1, 16).mapInArrow(slow, "id bigint")
    start, times = time.monotonic(), []
    for batch in stream_batches(df, 100):
        times.append((time.monotonic() - start, batch.column("id")[0].as_py()))
    assert [first for _, first in times] == list(range(0, 1_600, 100))
    assert times[-1][0] - times[0][0] > 2


def test_little_is_held(spark, monkeypatch):
    monkeypatch.setattr(batches, "AHEAD_BYTES", 10_000)
    stream = stream_batches(spark.range(0, 100_000, 1, 4), 1_000)
    first = next(stream)
    time.sleep(1)
    assert first.num_rows == 1_000
    stream.close()


def test_errors_reach_the_consumer(spark):
    df = spark.range(0, 400, 1, 4).selectExpr("IF(id = 399, CAST(raise_error('broken') AS BIGINT), id) AS id")
    with pytest.raises(Exception, match="broken"):
        list(stream_batches(df, 10))


def test_no_rows(spark):
    assert list(stream_batches(spark.range(0), 10)) == []
    assert list(stream_batches(spark.range(10).where("id > 20"), 10)) == []
