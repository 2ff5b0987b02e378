"""The index of dump files: what it holds, what a range scan opens, the files as a relation."""

import pytest
from pyspark.sql import functions as F

from rangeloom.functions.types import struct_of
from rangeloom.sources import dump, dump_index
from rangeloom.sources.dump_index import dump_relation, read_range, write_index

KIND = struct_of([("id", "Int64"), ("text", "Utf8"), ("n", "Int32")])


@pytest.fixture
def indexed(spark, tmp_path):
    """Two files, 3000 keys in order, a few NULL ones at the end of the second; blocks of 8 KiB."""
    rows = spark.range(0, 3000, 1, 2).selectExpr(
        "IF(id < 2995, id, NULL) AS id", "concat('t', repeat('x', CAST(id % 60 AS INT))) AS text", "CAST(id % 7 AS INT) AS n"
    )
    dump.write_dumps(rows, str(tmp_path / "dumps"), KIND)
    index = write_index(spark, str(tmp_path / "dumps"), KIND, "id", str(tmp_path / "index"), 8 << 10)
    return index, tmp_path / "dumps", rows.cache()


def equal(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_blocks(spark, indexed):
    index, folder, rows = indexed
    blocks = sorted(spark.read.parquet(f"{index}/blocks").collect())
    assert len(blocks) > 12 and sum(b.rows for b in blocks) == 3000 and sum(b.null_keys for b in blocks) == 5
    for a, b in zip(blocks, blocks[1:]):
        assert a.greatest < b.least and (a.stop == b.start if a.path == b.path else a.stop is None)
    with pytest.raises(ValueError, match="declared an integer"):
        write_index(spark, str(folder), KIND, "text", f"{index}-text")


def test_ranges(spark, indexed):
    index, _, rows = indexed
    for lo, hi in ((0, 2999), (700, 733), (1499, 1500), (-5, -1), (2990, 9999)):
        assert equal(read_range(spark, index, lo, hi), rows.where(F.col("id").between(lo, hi)))
    assert equal(read_range(spark, index, 40, 50, ["n"]), rows.where("id BETWEEN 40 AND 50").select("n"))


def spoil(index, folder, spark, lo, hi):
    """Overwrite all blocks but those of a key range."""
    for b in spark.read.parquet(f"{index}/blocks").collect():
        if b.greatest is None or b.greatest < lo or b.least > hi:
            with open(b.path.removeprefix("file:"), "r+b") as file:
                file.seek(b.start)
                file.write(b"?" * ((b.stop or b.length) - b.start))


def test_unread_blocks_are_never_opened(spark, indexed):
    index, folder, rows = indexed
    wanted = rows.where("id BETWEEN 1000 AND 1010").collect()
    spoil(index, folder, spark, 1000, 1010)
    assert sorted(read_range(spark, index, 1000, 1010).collect()) == sorted(wanted)
    found = dump_relation(spark, index, for_one_query=True).where("id >= 1000 AND id <= 1010")
    assert sorted(found.collect()) == sorted(wanted)
    with pytest.raises(Exception, match="part-0000"):
        dump_relation(spark, index).collect()


def test_relation(spark, indexed):
    index, _, rows = indexed
    lines = dump_relation(spark, index, split_bytes=20_000)
    assert lines.rdd.getNumPartitions() > 5 and equal(lines, rows)
    lines.createOrReplaceTempView("dumped")
    found = spark.sql("SELECT n, count(*) AS c FROM dumped WHERE id >= 1500 GROUP BY n")
    assert equal(found, rows.where("id >= 1500").groupBy("n").agg(F.count("*").alias("c")))
    both = spark.sql("SELECT a.id, b.id AS other FROM dumped a JOIN dumped b ON a.id = b.id - 2000 WHERE a.id < 50 AND b.id > 2010")
    assert both.count() == 39 and lines.count() == 3000


@pytest.mark.parametrize(
    "test", ["id = 77 OR id IS NULL", "id IS NULL", "id = 5", "id > 2000 AND id < 2010", "id IN (3, 1700)", "id <= 4", "id > 5000", "n = 3 AND id < 100", "id IS NOT NULL", "true"]
)
def test_pushed_filters(spark, indexed, test):
    index, _, rows = indexed
    found = dump_relation(spark, index, split_bytes=20_000, for_one_query=True).where(test).collect()
    assert sorted(found, key=str) == sorted(rows.where(test).collect(), key=str)


def test_a_filter_leaves_few_tasks(spark, indexed):
    index, _, _ = indexed
    few = dump_relation(spark, index, split_bytes=1, for_one_query=True).where("id BETWEEN 1000 AND 1010")
    assert few.rdd.getNumPartitions() <= 2 < dump_relation(spark, index, split_bytes=1).rdd.getNumPartitions()


def test_only_asked_columns_are_decoded(spark, indexed):
    """Bytes of a text that are no UTF-8 matter only to those who read it."""
    index, folder, rows = indexed
    path = spark.read.parquet(f"{index}/blocks").first().path.removeprefix("file:")
    data = open(path, "rb").read()
    open(path, "wb").write(data.replace(b"txxxxx", b"t\xffxxxx", 1))
    assert equal(dump_relation(spark, index, ["n", "id"]), rows.select("n", "id"))
    with pytest.raises(Exception, match="invalid UTF-8"):
        dump_relation(spark, index, ["text"]).collect()


def test_wrong_schema_and_empty_index(spark, indexed, tmp_path):
    index, _, _ = indexed
    dump_index.register_source(spark)
    with pytest.raises(Exception, match="is not declared"):
        spark.read.format(dump_index.FORMAT).schema("n bigint").load(index).collect()
    dump.write_dumps(spark.range(0).selectExpr("id", "'' AS text", "1 AS n"), str(tmp_path / "none"), KIND)
    empty = write_index(spark, str(tmp_path / "none"), KIND, "id", str(tmp_path / "index0"))
    assert dump_relation(spark, empty).collect() == [] and read_range(spark, empty, 0, 9).collect() == []


def stages_of(spark, group, work):
    """The number of tasks of each stage that work runs."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
    return result, [info.numTasks for info in map(tracker.getStageInfo, stages) if info and info.numCompletedTasks]


def test_blocks_of_one_file_are_described_by_many_tasks(spark, tmp_path):
    rows = spark.range(0, 3000, 1, 1).selectExpr("id", "repeat('x', CAST(id % 60 AS INT)) AS text", "1 AS n")
    dump.write_dumps(rows, str(tmp_path / "dumps"), KIND)
    tasks = dump.count_tasks(dump.dump_files(spark, str(tmp_path / "dumps")), 1000)
    assert tasks > 16
    _, stages = stages_of(spark, "index", lambda: write_index(spark, str(tmp_path / "dumps"), KIND, "id", str(tmp_path / "index"), 1000))
    assert stages.count(tasks) == 3  # exits, entries, blocks; each read once


def test_a_relation_of_many_small_blocks_has_tasks_for_all_cores(spark, tmp_path):
    rows = spark.range(0, 9000, 1, 2).selectExpr("id", "repeat('x', CAST(id % 60 AS INT)) AS text", "1 AS n")
    dump.write_dumps(rows, str(tmp_path / "dumps"), KIND)
    index = write_index(spark, str(tmp_path / "dumps"), KIND, "id", str(tmp_path / "index"), 1000)
    lines = dump_relation(spark, index, split_bytes=1000)
    assert 8 <= lines.rdd.getNumPartitions() <= 8 * spark.sparkContext.defaultParallelism and equal(lines, rows)
