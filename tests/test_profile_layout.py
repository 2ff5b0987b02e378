import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rangeloom import profile_spec
from rangeloom.functions.skew import with_row_tag
from rangeloom.functions.types import struct_of
from rangeloom.operators import profile
from rangeloom.operators.layout import analyze_table, range_layout, write_range_layout
from rangeloom.operators.report import timed_load
from rangeloom.operators.load import load_parquet, load_table
from rangeloom.operators.profile import first_rows, first_rows_in_files, null_profile
from rangeloom.plans.row_ranges import make_row_plan, row_counts
from rangeloom.sources.synth import DECLARED_COLUMNS, synth_table


@pytest.mark.parametrize("final", [20, 0])
@pytest.mark.parametrize(
    "keys", ["id", "id * 1000", "pow(1.01, id % 3000)", "if(id < 3000, 1, id)", "if(id % 5 = 0, NULL, -id)"]
)
@pytest.mark.parametrize("n", [1, 100, 20_000])
def test_first_rows(spark, monkeypatch, final, keys, n):
    monkeypatch.setattr(profile, "ROWS_PER_FINAL_TASK", final)
    df = spark.range(0, 9000, numPartitions=6).selectExpr(f"CAST({keys} AS BIGINT) AS k", "id")
    sample = [r.k for r in first_rows(df, "k", n).collect()]
    place = lambda k: (k is None, k or 0)  # rows with a NULL key come last
    every = sorted((r.k for r in df.collect()), key=place)
    assert sorted(sample, key=place) == every[:n]


def test_first_rows_of_nothing(spark):
    assert first_rows(spark.range(0), "id", 10).count() == 0


def test_profile_looks_at_the_sample_only(spark):
    df = spark.range(100).selectExpr("id", "if(id < 60, NULL, id) AS v")
    schema = struct_of([("id", "Int64"), ("v", "Int64")])
    lines = {r.column_name: (r.rows, r.null_count) for r in null_profile(df, schema, "id", 50).collect()}
    assert lines == {"id": (50, 0), "v": (50, 50)}


def test_profile_of_a_spec(spark, folder):
    spec = {
        "connection_string": "spark",
        "query": f"SELECT event_id AS id, if(event_id % 4 = 0, NULL, event_type) FROM parquet.`{folder}/events.parquet`",
        "schema": [{"column_name": "id", "arrow_type": "Int64"}, {"column_name": "kind", "arrow_type": "Int32"}],
    }
    assert profile_spec(spark, spec, sample_rows=1000) == {"id": 0, "kind": 1000}


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """30,000 rows in files; 12,000 of them are copies of one row."""
    path = str(tmp_path_factory.mktemp("hot") / "t")
    spread = spark.range(18_000).selectExpr("id AS k", "id AS v")
    copies = spark.range(12_000).selectExpr("777L AS k", "0L AS v")
    spread.unionAll(copies).repartition(6).write.parquet(path)
    return spark.read.parquet(path)


def test_row_tag_tells_copies_apart(hot):
    assert with_row_tag(hot).agg(F.countDistinct("__row_tag")).first()[0] == 30_000
    joined = hot.join(hot.select("k").distinct(), "k")
    assert with_row_tag(joined).agg(F.countDistinct("__row_tag")).first()[0] == 30_000


def test_layout_splits_a_hot_key(hot):
    laid = range_layout(hot, "k", 10)
    sizes = [r["count"] for r in laid.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 30_000 and max(sizes) < 6_000
    assert laid.exceptAll(hot).count() == 0


def test_written_layout_prunes(hot, tmp_path):
    path = str(tmp_path / "laid")
    write_range_layout(hot, path, "k", 8, rows_per_file=2000)
    stats = []
    for name in glob.glob(path + "/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        assert meta.num_rows <= 2000
        column = meta.row_group(0).column(0).statistics
        stats.append((column.min, column.max))
    stats.sort()
    assert all(a[1] <= b[0] for a, b in zip(stats, stats[1:]))


def test_ordered_load_of_a_hot_key(hot):
    schema = struct_of([("k", "Int64"), ("v", "Int64")])
    rows = load_table(hot, schema, key="k", ordered=True).rows
    keys = [r.k for r in rows.collect()]
    assert keys == sorted(keys) and len(keys) == 30_000


def test_statistics(spark, hot):
    spark.sql("DROP TABLE IF EXISTS laid_out")
    range_layout(hot, "k", 4).write.saveAsTable("laid_out")
    analyze_table(spark, "laid_out", ["k"])
    described = {r.info_name: r.info_value for r in spark.sql("DESCRIBE EXTENDED laid_out k").collect()}
    assert (described["min"], described["max"]) == ("0", "17999")
    analyze_table(spark, "laid_out")
    spark.sql("DROP TABLE laid_out")


def test_timed_load(spark, folder):
    schema = struct_of([("doc_id", "Int64"), ("quality", "Int32"), ("toxic", "Int32")])
    report = timed_load(lambda: load_parquet(spark, f"{folder}/labels.parquet", schema, key="doc_id"))
    assert report.rows == 399 and report.n_partitions == 1
    assert report.total_sec >= report.execute_sec > 0
    assert "columns (in order): doc_id, quality, toxic" in str(report)


def test_generated_table(spark):
    one = synth_table(spark, 1000)
    two = synth_table(spark, 1000).repartition(3)
    assert one.exceptAll(two).count() == 0
    assert one.schema.simpleString() == struct_of(DECLARED_COLUMNS).simpleString()
    spread = one.agg(F.min("course_id"), F.max("course_id"), F.countDistinct("rating"), F.avg("score")).first()
    assert spread[:3] == (100, 110, 1000) and 40 < spread[3] < 60


def test_first_rows_in_files(spark, tmp_path):
    path = str(tmp_path / "a b")
    spark.range(0, 1000, 1, 9).selectExpr("id", "999 - id AS down").write.parquet(path)
    files = spark.read.parquet(path)
    for n in (1, 111, 112, 500, 1000, 5000):
        first = first_rows_in_files(files, n)
        assert sorted(r.id for r in first.collect()) == list(range(min(n, 1000)))
    one = first_rows_in_files(files, 50)
    assert len(one.inputFiles()) == 1 and len(first_rows_in_files(files, 300).inputFiles()) == 3
    assert first_rows_in_files(spark.read.schema("id long").parquet(str(tmp_path)), 0).count() == 0
    with pytest.raises(ValueError, match="plain scan"):
        first_rows_in_files(files.where("id > 5"), 10)


@pytest.mark.parametrize("rows", [3, 7, 100, 400, 5000])
def test_ranges_by_rows(spark, rows):
    """Keys from -500 on, dense at the one end, sparse at the other, one of them a fifth of all rows."""
    keys = spark.range(2000).selectExpr("IF(id % 5 = 0, 77, IF(id < 1000, id - 500, id * 1000)) AS k").unionAll(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    plan = make_row_plan(keys, "k", 2, rows)
    spans = plan.ranges
    assert all(a <= b for a, b in spans) and all(b[0] == a[1] + 1 for a, b in zip(spans, spans[1:]))
    lo, hi = keys.agg(F.min("k"), F.max("k")).first()
    assert (spans[0][0], spans[-1][1]) == (lo, hi)
    counts = row_counts(keys, "k", plan).collect()
    assert sum(c.rows_read for c in counts) == 2000 and len(counts) == plan.n_partitions
    if rows < 400:
        assert [(c.lo, c.rows_read) for c in counts if c.lo == c.hi == 77] == [(77, 401)]
        assert max(c.rows_read for c in counts if c.lo != 77) <= 1.1 * rows + 1
    if len(spans) < 50:
        tests = " + ".join(f"CAST({p} AS INT)" for p in plan.predicates("k"))
        assert keys.where("k IS NOT NULL").selectExpr(f"{tests} AS n").distinct().collect() == [(1,)]


def test_ranges_by_rows_of_few_keys(spark):
    assert make_row_plan(spark.range(0), "id", 4) is None
    assert make_row_plan(spark.range(1), "id", 4).ranges == ((0, 0),)
    ends = spark.createDataFrame([(-(2**63),), (2**63 - 1,), (None,)], "id bigint")
    plan = make_row_plan(ends, "id", 4)
    assert plan.ranges[0][0] == -(2**63) and plan.ranges[-1][1] == 2**63 - 1
    assert [r.rows_read for r in row_counts(ends, "id", plan).orderBy("lo").collect()] == [1, 1]
