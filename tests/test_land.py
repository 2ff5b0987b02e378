"""Landing: no policy loses rows, the log is all there is, the source is run once."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from rangeloom import load_landed, read_landing
from rangeloom.functions.types import struct_of
from rangeloom.operators import heal
from rangeloom.operators.counts import INDEX
from rangeloom.operators.land import Landing, land_ranges, most_at_once, read_log
from rangeloom.operators.load import LoadOptions, load_table
from rangeloom.plans.ranges import RangePlan
from rangeloom.sources.store import append_file

SCHEMA = struct_of([("id", "Int64"), ("n", "Int32")])
PLAN = RangePlan(0, 99, 10)


def reader(spark, broken=(), bad=()):
    """Keys 0..99; ranges in ``broken`` cannot be read, keys in ``bad`` have no number."""

    def read(lo, hi):
        lost = F.floor(F.col("id") / 10).isin(list(broken)) if broken else F.lit(False)
        text = F.when(F.col("id").isin(list(bad)) if bad else F.lit(False), "bad").otherwise(F.col("id").cast("string"))
        n = F.when(lost & (F.col("id") % 10 == 5), F.raise_error(F.lit("connection lost"))).otherwise(text)
        return spark.range(lo, hi + 1).select("id", n.alias("n"))

    return read


def test_safe_never_loses_an_unreadable_range(spark, tmp_path):
    read = reader(spark, broken=[4], bad=[73])
    with pytest.raises(RuntimeError, match="keys 40 to 49 cannot be read"):
        land_ranges(spark, read, PLAN, SCHEMA, str(tmp_path / "a"), on_error="safe")
    made = land_ranges(spark, read, PLAN, SCHEMA, str(tmp_path / "b"), on_error="safe", unreadable="null_rows", with_index=True)
    rows = made.rows.collect()
    assert len(rows) == 100
    assert sorted(r.id for r in rows if r.id is not None) == [k for k in range(100) if k // 10 != 4]
    assert [tuple(r) for r in rows if r.id is None] == [(4, None, None)] * 10
    assert [r.id for r in rows if r.n is None and r.id is not None] == [73]
    report = sorted(made.failures.collect())
    assert [tuple(r)[:5] for r in report] == [(4, 40, 49, 10, None), (7, 70, 79, 10, 1)]
    assert "connection lost" in report[0].first_error and report[1].first_error == "column 'n' is not Int32, first at id 73"
    with pytest.raises(ValueError, match="unreadable must be"):
        land_ranges(spark, read, PLAN, SCHEMA, str(tmp_path), unreadable="never")


def test_every_policy_from_one_landing(spark, tmp_path):
    calls = []

    def read(lo, hi):
        calls.append((lo, hi))
        return reader(spark, bad=[12, 13, 88])(lo, hi)

    made = land_ranges(spark, read, PLAN, SCHEMA, str(tmp_path), max_slices=1)
    assert calls == [(0, 99)]
    assert made.rows.where("id IS NULL").count() == 20 and made.rows.count() == 100
    safe = read_landing(spark, made.landing, on_error="safe", ordered=True)
    assert [r.id for r in safe.rows.collect()] == list(range(100))
    assert safe.rows.where("n IS NULL").count() == 3
    again = read_landing(spark, made.landing, on_error="null_partition", with_index=True)
    assert sorted(again.rows.groupBy(INDEX).count().collect()) == [(k, 10) for k in range(10)]
    assert sorted(again.failures.collect()) == sorted(made.failures.collect())
    with pytest.raises(RuntimeError, match="'n' is not Int32, first at id"):
        read_landing(spark, made.landing, on_error="fail")
    assert calls == [(0, 99)]


def test_an_interrupted_landing_goes_on(spark, tmp_path):
    """A driver that died: some slices committed, one written but not committed."""
    healthy, calls = reader(spark, bad=[5]), []
    options = LoadOptions(on_error="safe")
    first = Landing(spark, healthy, PLAN, SCHEMA, str(tmp_path), options)
    first.land(0, 2)
    first.land(7, 7)
    spark.range(3).selectExpr(f"1L AS {INDEX}", "id", "1 AS n").write.parquet(f"{first.root}/__piece=dead/{heal.BAD}=false")

    def read(lo, hi):
        calls.append((lo, hi))
        return healthy(lo, hi)

    made = land_ranges(spark, read, PLAN, SCHEMA, str(tmp_path), on_error="safe", max_slices=2)
    assert sorted(calls) == [(30, 59), (60, 69), (80, 99)]
    assert sorted(r.id for r in made.rows.collect()) == list(range(100))
    assert [(r.partition_index, r.n_bad) for r in made.failures.collect()] == [(0, 1)]


def test_slices_of_two_drivers_count_once(spark, tmp_path):
    landing = Landing(spark, reader(spark, bad=[41]), PLAN, SCHEMA, str(tmp_path), LoadOptions(on_error="safe"))
    for first, last in ((0, 4), (3, 9), (3, 4), (0, 4)):
        landing.land(first, last)
    made = landing.loaded()
    assert sorted(r.id for r in made.rows.collect()) == list(range(100))
    assert [(r.partition_index, r.n_bad) for r in made.failures.collect()] == [(4, 1)]


def test_a_range_read_later_is_no_failure_any_more(spark, tmp_path):
    broken = land_ranges(spark, reader(spark, broken=[2, 6]), PLAN, SCHEMA, str(tmp_path))
    assert broken.failures.count() == 2 and broken.rows.where("id IS NULL").count() == 20
    forgotten = read_landing(spark, broken.landing)
    assert sorted(forgotten.failures.collect()) == sorted(broken.failures.collect()) and forgotten.rows.count() == 100
    mended = land_ranges(spark, reader(spark, broken=[6]), PLAN, SCHEMA, str(tmp_path))
    assert [r.partition_index for r in mended.failures.collect()] == [6]
    assert mended.rows.where("id IS NULL").count() == 10 and mended.rows.count() == 100


def test_bounds_of_failures(spark, tmp_path):
    with pytest.raises(RuntimeError, match="more than 1 ranges cannot be read"):
        land_ranges(spark, reader(spark, broken=[2, 6, 8]), PLAN, SCHEMA, str(tmp_path / "a"), max_failed=1)
    with pytest.raises(RuntimeError, match="keys 0 to 99 cannot be read: .*connection lost"):
        land_ranges(spark, reader(spark, broken=[2]), PLAN, SCHEMA, str(tmp_path / "b"), on_error="fail", max_slices=1)
    with pytest.raises(FileNotFoundError, match="not a landing"):
        read_landing(spark, str(tmp_path / "c"))


def spec_of(query):
    columns = [{"column_name": "id", "arrow_type": "Int64"}, {"column_name": "n", "arrow_type": "Int32"}]
    return {"connection_string": "spark", "query": query, "schema": columns}


def test_readers_are_capped(spark, tmp_path):
    for cap in (1, 3):
        made = land_ranges(spark, reader(spark), PLAN, SCHEMA, str(tmp_path / str(cap)), connections=cap)
        lines = read_log(spark, made.landing)
        assert lines.count() == 10 and most_at_once(lines) <= cap


def test_null_keys_land_or_raise(spark, tmp_path):
    keys = "SELECT if(id % 10 = 3, NULL, id) AS id, {} AS n FROM range(50)"
    bad = spec_of(keys.format("if(id = 13, 'bad', CAST(id AS STRING))"))
    healed = load_landed(spark, bad, str(tmp_path), 10, parallelism=2, null_keys="keep")
    assert healed.rows.count() == 50 and healed.rows.where("id IS NULL AND n IS NULL").count() == 5
    line = healed.failures.first()
    assert (line.partition_index, line.expected_rows, line.first_error) == (None, 5, "column 'n' is not Int32, at a NULL key")
    safe = read_landing(spark, healed.landing, on_error="safe")
    assert safe.rows.where("id IS NULL").count() == 5 and safe.rows.where("n IS NULL").count() == 1
    lost = spec_of(keys.format("if(id = 13, CAST(raise_error('lost') AS STRING), CAST(id AS STRING))"))
    for policy in ("null_partition", "safe"):
        with pytest.raises(RuntimeError, match="NULL key cannot be read"):
            load_landed(spark, lost, str(tmp_path), 10, parallelism=2, null_keys="keep", on_error=policy, unreadable="null_rows")
    assert load_landed(spark, lost, str(tmp_path), 10, parallelism=2).rows.count() == 45
    only = spec_of("SELECT CAST(NULL AS BIGINT) AS id, 'bad' AS n FROM range(4)")
    nothing = load_landed(spark, only, str(tmp_path), 10, parallelism=2, null_keys="keep")
    assert nothing.rows.count() == 4 and nothing.plan is None and read_landing(spark, nothing.landing).rows.count() == 4


def test_a_log_line_is_whole_or_not_there(spark, tmp_path):
    path = f"{tmp_path}/log/{uuid.uuid4().hex}.json"
    append_file(spark, path, json.dumps({"lo": 1}))
    assert json.loads(open(path).read()) == {"lo": 1}
    assert [p.name for p in (tmp_path / "log").iterdir() if not p.name.endswith(".crc")] == [path.rsplit("/", 1)[1]]


def test_healing_runs_the_source_once(spark, capsys):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = spark.range(200).selectExpr("id", "if(id IN (7, 150), 'bad', CAST(id AS STRING)) AS n").mapInArrow(count, "id bigint, n string")
    loaded = load_table(source, SCHEMA, 10, on_error="null_partition", bounds=lambda: (0, 199))
    assert loaded.rows.count() == 200 and loaded.rows.where("id IS NULL").count() == 20
    assert sorted(r.partition_index for r in loaded.failures.collect()) == [0, 15]
    assert seen.value == 200
