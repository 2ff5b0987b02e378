"""What becomes of a range that holds a value which does not fit its type.

A task that throws ends the whole job, so bad data is never thrown: which test a row
failed is a value, the failures are summed up per range, and that verdict decides
which ranges are replaced or rerun.

Healing runs the source once. Rows are written as a safe decode gives them, those that
failed a test to a folder of their own; how many there are is observed in passing. If
there are none, that is the verdict; else it is found in that folder alone. What is read
afterwards is what was written, so all uses of a verdict agree.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rangeloom.functions.casts import sql_text
from rangeloom.functions.names import quoted
from rangeloom.functions.skew import ROW_TAG, with_row_tag
from rangeloom.functions.types import declared_name
from rangeloom.operators.bind import bind_types, typed_columns
from rangeloom.operators.counts import INDEX
from rangeloom.plans.ranges import RangePlan
from rangeloom.plans.session import cut_lineage, scratch_path

REPORT = (
    f"{INDEX} bigint, lo bigint, hi bigint, expected_rows bigint, n_bad bigint, first_error string"
)

# Columns of flagged rows: which test a row failed and what that means, the key it has
# (all NULL for good rows, and so next to nothing in Parquet), and whether it failed any.
TEST, ERROR, FAILED_KEY, BAD = "__test", "__error", "__failed_key", "__bad"

# A verdict of this many ranges (8 bytes each) is still broadcast; a longer one is
# joined by a shuffle that cuts each range into so many parts per core of the cluster.
BROADCAST_RANGES = 1_000_000
SALTS_PER_CORE = 4

# NULL rows are made from nested runs of at most this many, never one long array.
RUN_ROWS = 10_000


@dataclass(frozen=True)
class Verdict:
    """Failed ranges ``(partition_index, lo, hi, expected_rows, n_bad, first_error)``."""

    report: DataFrame
    n_failed: int


def _tests(
    named: DataFrame, schema: T.StructType, rule: str | None, check_utf8: bool
) -> list[tuple[str, str]]:
    """SQL tests that mark a row as bad, and what each of them means."""
    tests = [
        (t.failed, f"column '{t.name}' is not {declared_name(t.target)}")
        for t in typed_columns(named, schema, check_utf8)
        if t.failed is not None
    ]
    return tests if rule is None else [*tests, (rule, "refused by rule")]


def failed_partitions(
    named: DataFrame,
    schema: T.StructType,
    key: str,
    plan: RangePlan,
    rule: str | None = None,
    check_utf8: bool = False,
) -> DataFrame:
    """Report of the ranges that hold a bad row.

    ``named`` holds the source values under their declared names, with a range index.
    ``rule`` is an SQL condition on them that marks further rows as bad. Of a bad row
    only numbers go on (its range, its key, which test it failed), so that hash
    aggregation brings them down to a few rows per task before the shuffle.

    Rows with a NULL key, where they were kept, are a range of their own, whose index,
    bounds and ``expected_rows`` are NULL here; :func:`judge` counts the last.
    """
    tests = _tests(named, schema, rule, check_utf8)
    if not tests:
        return named.sparkSession.createDataFrame([], REPORT)
    cases = " ".join(f"WHEN {test} THEN {i}" for i, (test, _) in enumerate(tests))
    meanings = ", ".join(sql_text(meaning) for _, meaning in tests)
    found = (
        named.selectExpr(INDEX, f"{quoted(key)} AS k", f"CASE {cases} END AS test")
        .where("test IS NOT NULL")
        .groupBy(INDEX, "test")
        .agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("k"))
        .groupBy(INDEX)
        .agg(F.sum("n").alias("n_bad"), F.expr("min(struct(k, test))").alias("first"))
    )
    place = f"coalesce(concat({sql_text(f', first at {key} ')}, first.k), {sql_text(', at a NULL key')})"
    error = f"concat(array({meanings})[first.test], {place})"
    described = found.selectExpr(INDEX, *plan.describe(), "n_bad", f"{error} AS first_error")
    known = [F.when(F.col(INDEX).isNotNull(), F.col(c)).alias(c) for c in ("lo", "hi", "expected_rows")]
    return described.select(INDEX, *known, "n_bad", "first_error")


def judge(
    named: DataFrame,
    schema: T.StructType,
    key: str,
    plan: RangePlan,
    rule: str | None = None,
    check_utf8: bool = False,
) -> Verdict:
    """Find the failed ranges, once; no pass over the data if no column can fail."""
    report = failed_partitions(named, schema, key, plan, rule, check_utf8)
    if not _tests(named, schema, rule, check_utf8):
        return Verdict(report, 0)
    report = cut_lineage(report)
    n_failed, n_ranges = report.select(F.count("*"), F.count(INDEX)).first()
    if n_ranges < n_failed:  # the NULL keys are among them
        n_null = named.where(f"{INDEX} IS NULL").count()
        expected = F.coalesce(F.col("expected_rows"), F.lit(n_null).cast("bigint"))
        report = report.withColumn("expected_rows", expected)
    return Verdict(report, n_failed)


def _join_failed(rows: DataFrame, failed: DataFrame, n_failed: int, how: str) -> DataFrame:
    """Join rows to the failed ranges: broadcast within the bound, else salted.

    A NULL index, that of NULL keys, matches itself.
    """
    columns = rows.columns
    added = [] if how == "left_anti" else [c for c in failed.columns if c != INDEX]
    place = F.coalesce(F.col(INDEX), F.lit(-1)).alias("__range")
    failed = failed.select(place, *added)
    if n_failed <= BROADCAST_RANGES:
        return rows.select("*", place).join(F.broadcast(failed), "__range", how).select(*columns, *added)
    salts = SALTS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism
    tagged = rows if ROW_TAG in columns else with_row_tag(rows)
    spread = tagged.select("*", place, F.pmod(F.col(ROW_TAG), F.lit(salts)).cast("int").alias("__salt"))
    salted = failed.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(salted, ["__range", "__salt"], how).select(*columns, *added)


def without_failed(rows: DataFrame, verdict: Verdict) -> DataFrame:
    if verdict.n_failed == 0:
        return rows
    return _join_failed(rows, verdict.report.select(INDEX), verdict.n_failed, "left_anti")


def null_rows(report: DataFrame, schema: T.StructType, tagged: bool = False) -> DataFrame:
    """``expected_rows`` all-NULL rows for each range of the report, with its index.

    ``tagged`` adds the row's place in its range as a row tag.

    Runs of runs of runs are unfolded one level at a time and spread over the
    cluster while they are few, so one wide range does not fill one task.
    """

    def unfold(df: DataFrame, unit: int) -> DataFrame:
        starts = f"explode(sequence(0L, n - 1L, {unit}L)) AS at"
        return df.selectExpr(INDEX, "base", "n", starts).selectExpr(
            INDEX, "base + at AS base", f"least(n - at, {unit}L) AS n"
        )

    tasks = report.sparkSession.sparkContext.defaultParallelism
    runs = report.where("expected_rows > 0").selectExpr(INDEX, "0L AS base", "expected_rows AS n")
    for unit in (RUN_ROWS**4, RUN_ROWS**3, RUN_ROWS**2):
        runs = unfold(runs, unit)
    for unit in (RUN_ROWS, 1):
        runs = unfold(runs.repartition(tasks), unit)
    place = [f"base AS {ROW_TAG}"] if tagged else []
    nulls = [f"CAST(NULL AS {f.dataType.simpleString()}) AS {quoted(f.name)}" for f in schema.fields]
    return runs.selectExpr(INDEX, *place, *nulls)


@dataclass(frozen=True)
class Written:
    """What was seen while flagged rows were written."""

    rows: int
    n_bad: int
    n_null_keys: int


def flagged(
    named: DataFrame, schema: T.StructType, key: str, rule: str | None = None, check_utf8: bool = False
) -> DataFrame:
    """Rows as a safe decode gives them, with their index (and tag, if any), marked if they failed a test."""
    tests = _tests(named, schema, rule, check_utf8)
    cases = " ".join(f"WHEN {test} THEN {i}" for i, (test, _) in enumerate(tests))
    test = f"CASE {cases} END" if tests else "CAST(NULL AS INT)"
    meanings = ", ".join(sql_text(meaning) for _, meaning in tests)
    kept = [INDEX, *([ROW_TAG] if ROW_TAG in named.columns else [])]
    marked = bind_types(
        named.selectExpr("*", f"{test} AS {TEST}", f"{quoted(key)} AS {FAILED_KEY}"),
        schema, "safe", [*kept, TEST, FAILED_KEY], check_utf8,
    )
    failed = f"{TEST} IS NOT NULL"
    return marked.selectExpr(
        *kept, *map(quoted, schema.names), TEST,
        f"CASE WHEN {failed} THEN array({meanings})[{TEST}] END AS {ERROR}" if tests else f"CAST(NULL AS STRING) AS {ERROR}",
        f"CASE WHEN {failed} THEN CAST({FAILED_KEY} AS BIGINT) END AS {FAILED_KEY}",
        f"{failed} AS {BAD}",
    )


def write_flagged(rows: DataFrame, path: str) -> Written:
    """Write flagged rows, the bad ones apart, and count them on the way."""
    seen = Observation()
    watched = rows.observe(
        seen, F.count("*").alias("rows"), F.count_if(F.col(BAD)).alias("n_bad"), F.count_if(F.col(INDEX).isNull()).alias("n_null")
    )
    watched.write.partitionBy(BAD).parquet(path)
    found = seen.get
    return Written(found["rows"], found["n_bad"], found["n_null"])


def flagged_schema(schema: T.StructType, tagged: bool = False) -> T.StructType:
    """The columns of :func:`flagged`."""
    tag = [T.StructField(ROW_TAG, T.LongType())] if tagged else []
    marks = [(TEST, T.IntegerType()), (ERROR, T.StringType()), (FAILED_KEY, T.LongType()), (BAD, T.BooleanType())]
    return T.StructType([T.StructField(INDEX, T.LongType()), *tag, *schema.fields, *[T.StructField(*m) for m in marks]])


def verdict_of(bad: DataFrame, key: str, plan: RangePlan, n_null_keys: int) -> DataFrame:
    """The report on the ranges that bad flagged rows are in; their NULL keys are a range of ``n_null_keys`` rows."""
    found = (
        bad.groupBy(INDEX, TEST)
        .agg(F.count("*").alias("n"), F.min(FAILED_KEY).alias("k"), F.first(ERROR).alias("error"))
        .groupBy(INDEX)
        .agg(F.sum("n").alias("n_bad"), F.expr(f"min(struct(k, {TEST}, error))").alias("first"))
    )
    place = f"coalesce(concat({sql_text(f', first at {key} ')}, first.k), {sql_text(', at a NULL key')})"
    described = found.selectExpr(INDEX, *plan.describe(), "n_bad", f"concat(first.error, {place}) AS first_error")
    known = [F.when(F.col(INDEX).isNotNull(), F.col(c)).alias(c) for c in ("lo", "hi")]
    expected = F.when(F.col(INDEX).isNotNull(), F.col("expected_rows")).otherwise(F.lit(n_null_keys).cast("bigint"))
    return described.select(INDEX, *known, expected.alias("expected_rows"), "n_bad", "first_error")


def no_failures(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], REPORT)


def heal_partitions(
    named: DataFrame,
    schema: T.StructType,
    key: str,
    plan: RangePlan,
    rule: str | None = None,
    check_utf8: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Replace each failed range by ``expected_rows`` NULL rows, and nothing else.

    ``named`` holds the source values under their declared names, with a range index.
    Returns the rows (with their index, and their row tag if they came with one) and
    the report of failed ranges. The source is run once, and not staged at all if no
    column can fail.
    """
    spark, tags = named.sparkSession, [ROW_TAG] if ROW_TAG in named.columns else []
    if not _tests(named, schema, rule, check_utf8):
        return bind_types(named, schema, "safe", [INDEX, *tags], check_utf8), no_failures(spark)
    path = scratch_path(spark, "healed")
    seen = write_flagged(flagged(named, schema, key, rule, check_utf8), path)
    written = spark.read.schema(flagged_schema(schema, bool(tags))).parquet(path)
    good = written.where(f"NOT {BAD}").selectExpr(INDEX, *tags, *map(quoted, schema.names))
    if not seen.n_bad:
        return good, no_failures(spark)
    report = cut_lineage(verdict_of(written.where(BAD), key, plan, seen.n_null_keys))
    rows = without_failed(good, Verdict(report, report.count()))
    return rows.unionByName(null_rows(report, schema, bool(tags))), report


def safe_rerun(
    named: DataFrame,
    schema: T.StructType,
    key: str,
    plan: RangePlan,
    rule: str | None = None,
    check_utf8: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Keep clean ranges as they are and decode failed ones value by value.

    A safe cast of a clean range gives what a strict one would, so both kinds come
    out of one scan. Returns the rows (with their index) and the list of ranges that
    had to be rerun.
    """
    rows = bind_types(named, schema, "safe", [INDEX], check_utf8)
    return rows, judge(named, schema, key, plan, rule, check_utf8).report


def mark_rerun(rows: DataFrame, report: DataFrame) -> DataFrame:
    """Add ``rerun``: whether the row's range is in the report (a few rows by now)."""
    failed = report.select(INDEX, F.lit(True).alias("rerun"))
    marked = _join_failed(rows, failed, report.count(), "left")
    return marked.withColumn("rerun", F.coalesce("rerun", F.lit(False)))
