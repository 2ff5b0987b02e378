import collections

import pytest
from pyspark.sql import functions as F

from rangeloom.functions.types import struct_of
from rangeloom.operators import heal
from rangeloom.operators.bind import rename_by_position
from rangeloom.operators.counts import INDEX, with_partition
from rangeloom.operators.load import load_table
from rangeloom.plans.ranges import RangePlan

SCHEMA = struct_of([("id", "Int64"), ("n", "Int32")])


@pytest.fixture
def dirty(spark):
    """Keys 0..999, key 500 repeated 2000 times; a bad value at 137, 138 and 990."""
    keys = spark.range(1000).unionAll(spark.range(2000).selectExpr("500L AS id"))
    return keys.selectExpr("id", "if(id IN (137, 138, 990), 'bad', CAST(id AS STRING)) AS n").repartition(7)


def expected_rows(width):
    keys = collections.Counter({k: 1 for k in range(1000)}) + collections.Counter({500: 2000})
    failed = {137 // width, 990 // width}
    rows = collections.Counter()
    for k, n in keys.items():
        if k // width not in failed:
            rows[(k // width, k, k)] += n
    for i in failed:
        rows[(i, None, None)] += min(width, 1000 - i * width)
    return rows


def counted(df):
    return collections.Counter(map(tuple, df.select(INDEX, "id", "n").collect()))


@pytest.mark.parametrize("width", [7, 100, 1000])
@pytest.mark.parametrize("limit", [heal.BROADCAST_RANGES, 0])
def test_heal(spark, dirty, monkeypatch, width, limit):
    monkeypatch.setattr(heal, "BROADCAST_RANGES", limit)
    monkeypatch.setattr(heal, "RUN_ROWS", 10)
    plan = RangePlan(0, 999, width)
    named = with_partition(rename_by_position(dirty, SCHEMA), "id", plan)
    rows, report = heal.heal_partitions(named, SCHEMA, "id", plan)
    assert counted(rows) == expected_rows(width)
    first = {r[INDEX]: (r.n_bad, r.first_error) for r in report.collect()}
    assert {e for _, e in first.values()} <= {
        f"column 'n' is not Int32, first at id {k}" for k in (137, 138, 990)
    }
    assert sum(n for n, _ in first.values()) == 3


@pytest.mark.parametrize("limit", [heal.BROADCAST_RANGES, 0])
def test_rerun(dirty, monkeypatch, limit):
    monkeypatch.setattr(heal, "BROADCAST_RANGES", limit)
    plan = RangePlan(0, 999, 10)
    named = with_partition(rename_by_position(dirty, SCHEMA), "id", plan)
    marked = heal.mark_rerun(*heal.safe_rerun(named, SCHEMA, "id", plan))
    rerun = marked.where("rerun").agg(F.collect_set(INDEX)).first()[0]
    assert sorted(rerun) == [13, 99]
    assert marked.count() == 3000 and marked.where("n IS NULL").count() == 3


def test_no_failures_add_no_join(dirty, capsys):
    plan = RangePlan(0, 999, 10)
    clean = dirty.where("n <> 'bad'")
    named = with_partition(rename_by_position(clean, SCHEMA), "id", plan)
    rows, report = heal.heal_partitions(named, SCHEMA, "id", plan)
    rows.explain()
    assert "Join" not in capsys.readouterr().out and report.count() == 0


def test_rule(dirty):
    loaded = load_table(
        dirty.where("n <> 'bad'"), SCHEMA, 100, on_error="null_partition", rule="id = 250"
    )
    line = loaded.failures.first()
    assert (line[INDEX], line.lo, line.hi, line.n_bad) == (2, 200, 299, 1)
    assert line.first_error == "refused by rule, first at id 250"


def test_null_rows_of_a_wide_range(spark):
    report = spark.createDataFrame([(3, 250_001), (4, 0), (5, 1)], f"{INDEX} bigint, expected_rows bigint")
    nulls = heal.null_rows(report, SCHEMA, tagged=True)
    found = nulls.groupBy(INDEX).agg(F.count("*"), F.count("id"), F.countDistinct("__row_tag")).collect()
    assert sorted(map(tuple, found)) == [(3, 250_001, 0, 250_001), (5, 1, 0, 1)]
    sizes = nulls.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 200_000


@pytest.mark.parametrize("ordered", [False, True])
@pytest.mark.parametrize("null_keys, n", [("drop", 2999), ("keep", 3000)])
def test_null_keys_and_order(dirty, ordered, null_keys, n):
    source = dirty.selectExpr("if(id = 3, NULL, id) AS id", "n")
    loaded = load_table(
        source, SCHEMA, 100, on_error="safe", null_keys=null_keys, ordered=ordered, with_index=True
    )
    rows = loaded.rows.collect()
    assert len(rows) == n
    if ordered:
        keys = [(-1 if r.id is None else r.id) for r in rows]
        assert keys == sorted(keys)


def test_healed_rows_stand_where_their_range_does(dirty):
    rows = load_table(
        dirty, SCHEMA, 100, on_error="null_partition", ordered=True, with_index=True
    ).rows.collect()
    index = [r[INDEX] for r in rows]
    assert index == sorted(index) and len(rows) == 3000
    assert all((r.id is None) == (r[INDEX] in (1, 9)) for r in rows)


def test_safe_policy_lists_its_ranges(dirty):
    loaded = load_table(dirty, SCHEMA, 100, on_error="safe")
    assert loaded.rows.where("n IS NULL").count() == 3
    assert sorted(r[INDEX] for r in loaded.failures.collect()) == [1, 9]
    assert load_table(dirty, SCHEMA).failures is None


def test_fail_policy(dirty):
    with pytest.raises(Exception, match="column 'n': 'bad' is not Int32"):
        load_table(dirty, SCHEMA).rows.collect()
    with pytest.raises(ValueError, match="on_error"):
        load_table(dirty, SCHEMA, on_error="ignore")
    with pytest.raises(ValueError, match="null_keys"):
        load_table(dirty, SCHEMA, null_keys="maybe")


def test_refused_schemas(dirty):
    text_key = struct_of([("id", "Utf8"), ("n", "Utf8")])
    with pytest.raises(ValueError, match="declared an integer"):
        load_table(dirty, text_key, ordered=True)
    assert load_table(dirty, text_key, with_index=True).rows.count() == 3000
    with pytest.raises(ValueError, match="range index"):
        load_table(dirty, struct_of([("id", "Int64"), ("Partition_Index", "Utf8")]))


def test_plain_load_runs_no_bounds_query(table, capsys):
    schema = struct_of([("k", "Int64"), ("quality", "Int32"), ("toxic", "Int32")])
    loaded = load_table(table("labels"), schema, key="doc_id")
    loaded.rows.explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "PushedFilters: [IsNotNull(doc_id)]" in plan
    assert loaded.plan.width == 10_000 and loaded.plan is loaded.plan


def test_empty_source(spark):
    empty = spark.range(0).selectExpr("id", "CAST(id AS STRING) AS n")
    for on_error in ("fail", "null_partition", "safe"):
        loaded = load_table(empty, SCHEMA, on_error=on_error, with_index=True)
        assert loaded.rows.columns == [INDEX, "id", "n"]
        assert loaded.rows.count() == 0 and loaded.plan is None
