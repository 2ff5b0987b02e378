from hypothesis import given, settings
from hypothesis import strategies as st
import random

import pytest
from pyspark.sql import functions as F

from rangeloom.operators.counts import INDEX, partition_counts, with_partition
from rangeloom.operators.packing import pack_batches
from rangeloom.plans.ranges import RangePlan, autotune_width, make_plan
from rangeloom.sources.queries import key_bounds, key_position, parquet_key_bounds

LONG = st.integers(-(2**63), 2**63 - 1)


@given(LONG, LONG, st.integers(2, 2**40), st.integers(1, 50))
@settings(max_examples=300)
def test_slices_cover_the_span_once(a, b, width, n):
    plan = RangePlan(min(a, b), max(a, b), width)
    slices = plan.slices(n)
    assert len(slices) == min(n, plan.n_partitions)
    assert slices[0][0] == plan.lo and slices[-1][1] == plan.hi
    assert all(lo <= hi for lo, hi in slices)
    assert all(after[0] == before[1] + 1 for before, after in zip(slices, slices[1:]))


@pytest.mark.parametrize(
    "lo, hi, width",
    [(0, 14999, 1000), (5, 5, 10), (-7, 12, 3), (2**63 - 10, 2**63 - 1, 4), (-(2**63), 2**63 - 1, 2**61)],
)
def test_plan_rows(spark, lo, hi, width):
    plan = RangePlan(lo, hi, width)
    rows = sorted(plan.frame(spark).collect())
    assert [r.partition_index for r in rows] == list(range(plan.n_partitions))
    assert [r.lo for r in rows] == [lo + i * width for i in range(plan.n_partitions)]
    assert [r.hi for r in rows] == [min(r.lo + width - 1, hi) for r in rows]
    assert sum(r.expected_rows for r in rows) == hi - lo + 1


def test_autotuned_width():
    assert autotune_width(15_000, 4) == 10_000
    assert autotune_width(16_000_000, 4) == 1_000_000
    assert autotune_width(16_000_000, 4, 50) == 50
    assert autotune_width(16_000_000, 4, -1) == 1_000_000
    assert make_plan(None, 4) is None


def test_extreme_keys(spark):
    keys = [-(2**63), -1, 0, 1, 2**63 - 1, None]
    df = spark.createDataFrame([(k,) for k in keys], "id bigint")
    plan = make_plan(key_bounds(df, "id"), 4)
    assert plan.span == 2**64
    found = {r.id: r[INDEX] for r in with_partition(df, "id", plan).collect()}
    assert found == {k: (k - plan.lo) // plan.width for k in keys if k is not None}
    counted = partition_counts(df, "id", plan).agg(F.sum("rows_read"), F.count("*")).first()
    assert tuple(counted) == (5, plan.n_partitions)


def test_bounds(spark, table, folder):
    empty = table("orders").where("false")
    assert key_bounds(empty, "o_orderkey") is None
    assert parquet_key_bounds(spark, f"{folder}/orders.parquet", "O_ORDERKEY") == (0, 14999)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    assert "parquet" in before  # the caller's session is left as it was


def test_footer_bounds_without_statistics(spark, tmp_path):
    path = str(tmp_path / "nulls")
    spark.range(10).selectExpr("CAST(NULL AS BIGINT) AS id", "id AS x").write.parquet(path)
    assert parquet_key_bounds(spark, path, "id") is None
    path = str(tmp_path / "partly")
    spark.range(10).selectExpr("if(id > 3, id, NULL) AS id").repartition(5).write.parquet(path)
    assert parquet_key_bounds(spark, path, "id") == (4, 9)
    path = str(tmp_path / "none")
    spark.range(0).toDF("id").write.parquet(path)
    assert parquet_key_bounds(spark, path, "id") is None


def test_key_must_be_one_integer_column(table):
    schema = table("orders").schema
    assert key_position(schema, "O_CUSTKEY") == 1
    with pytest.raises(ValueError, match="not an integer"):
        key_position(schema, "o_orderstatus")
    with pytest.raises(ValueError, match="exactly one"):
        key_position(schema, "id")


def test_range_filter_reaches_the_scan(table, capsys):
    plan = RangePlan(100, 200, 10)
    with_partition(table("orders"), "o_orderkey", plan).explain()
    assert "GreaterThanOrEqual(o_orderkey,100), LessThanOrEqual(o_orderkey,200)" in capsys.readouterr().out


def greedy(counts, target):
    batches, first, rows = [], None, 0
    for i, n in enumerate(counts):
        first = i if first is None else first
        rows += n
        if rows >= target:
            batches.append((first, i, rows, False))
            first, rows = None, 0
    return batches + ([(first, len(counts) - 1, rows, True)] if rows else [])


@pytest.mark.parametrize("counts", [[], [0], [0, 0, 5], [3, 9, 1, 1, 0, 20, 4], [10] * 7, [1] * 40])
@pytest.mark.parametrize("target", [1, 10, 1000])
def test_packing(spark, counts, target):
    df = spark.createDataFrame(list(enumerate(counts)), f"{INDEX} bigint, rows_read bigint")
    packed = pack_batches(df.repartition(3), target).drop("worker").collect()
    assert sorted(map(tuple, packed)) == greedy(counts, target)


def test_packing_by_worker(spark):
    counts = [(7 * i) % 5 for i in range(50)]
    df = spark.createDataFrame(list(enumerate(counts)), f"{INDEX} bigint, rows_read bigint")
    expected = []
    for worker in range(5):
        part = greedy(counts[worker * 10 : worker * 10 + 10], 6)
        expected += [(worker, a + worker * 10, b + worker * 10, n, left) for a, b, n, left in part]
    assert sorted(map(tuple, pack_batches(df, 6, partitions_per_worker=10).collect())) == expected


def test_pack_many_ranges_of_one_worker(spark):
    counts = spark.range(5000).selectExpr(f"id AS {INDEX}", "id % 7 AS rows_read")
    packed = pack_batches(counts, 9).collect()
    want, first, pending = [], None, 0
    for i in range(5000):
        first, pending = i if first is None else first, pending + i % 7
        if pending >= 9:
            want.append((0, first, i, pending, False))
            first, pending = None, 0
    assert sorted(map(tuple, packed)) == want + [(0, first, 4999, pending, True)] * (pending > 0)
    two = pack_batches(counts, 9, workers=2).collect()
    assert {(r.worker, r.first_partition) for r in two} >= {(0, 0), (1, 2500)}


@pytest.mark.parametrize("seed, size, target, block", [(1, 97, 9, 4), (2, 64, 30, 1), (3, 200, 1, 7), (4, 150, 2000, 8), (5, 120, 12, 200), (6, 80, 5, 3)])
def test_packing_over_blocks(spark, seed, size, target, block):
    """Batches that run over many blocks, in one worker and in several."""
    rng = random.Random(seed)
    counts = [rng.choice([0, 0, 1, 3, rng.randint(0, 40)]) for _ in range(size)]
    df = spark.createDataFrame(list(enumerate(counts)), f"{INDEX} bigint, rows_read bigint").repartition(3)
    one = pack_batches(df, target, block_ranges=block).drop("worker").collect()
    assert sorted(map(tuple, one)) == greedy(counts, target)
    per, expected = 33, []
    for worker, a in enumerate(range(0, size, per)):
        part = greedy(counts[a : a + per], target)
        expected += [(worker, x + a, y + a, n, left) for x, y, n, left in part]
    several = pack_batches(df, target, partitions_per_worker=per, block_ranges=block).collect()
    assert sorted(map(tuple, several)) == expected
