"""The partitioned load: spec or table in, typed DataFrame out."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache, cached_property, partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rangeloom.functions.casts import sql_text
from rangeloom.functions.names import quoted
from rangeloom.functions.skew import ROW_TAG, with_row_tag
from rangeloom.operators import heal
from rangeloom.operators.bind import bind_types, rename_by_position
from rangeloom.operators.counts import INDEX, with_partition
from rangeloom.plans.ranges import RangePlan, default_parallelism, make_plan
from rangeloom.plans.session import scratch_path
from rangeloom.plans.spec import DEFAULT_BATCH_SIZE, LoadSpec, as_spec
from rangeloom.sources import jdbc, queries
from rangeloom.streaming.batches import stream_batches

ON_ERROR = ("fail", "null_partition", "safe")
NULL_KEYS = ("drop", "keep")

# Stands for the plan of a source with NULL keys only: all its rows are the range of those.
NO_KEYS = RangePlan(0, 0, 1)

# Database statements (= tasks) of one load unless the caller sets another number; finer
# plans are read in runs of adjacent ranges.
MAX_STATEMENTS = 20_000


@dataclass(frozen=True)
class LoadOptions:
    """How a source is turned into rows; see :func:`load`."""

    key: str = "id"
    on_error: str = "fail"
    null_keys: str = "drop"
    ordered: bool = False
    with_index: bool = False
    check_utf8: bool = False
    rule: str | None = None

    def __post_init__(self) -> None:
        if self.on_error not in ON_ERROR:
            raise ValueError(f"on_error must be one of {ON_ERROR}")
        if self.null_keys not in NULL_KEYS:
            raise ValueError(f"null_keys must be one of {NULL_KEYS}")

    @property
    def heals(self) -> bool:
        return self.on_error == "null_partition"


class Loaded:
    """A load: its rows, its plan (None if the source has no keys) and its failures.

    ``failures`` lists the ranges that were replaced, or in which values became NULL; it
    is None under ``on_error="fail"``. A plan or a list that the rows did not need is made
    when it is first asked for.
    """

    def __init__(
        self,
        rows: DataFrame,
        make_plan: Callable[[], RangePlan | None],
        find_failures: Callable[[], DataFrame | None] = lambda: None,
        batch_size: int = DEFAULT_BATCH_SIZE,
    ):
        self.rows = rows
        self.batch_size = batch_size
        self.landing: str | None = None  # where it landed, for read_landing
        self._make_plan = make_plan
        self._find_failures = find_failures

    @cached_property
    def plan(self) -> RangePlan | None:
        return self._make_plan()

    @cached_property
    def failures(self) -> DataFrame | None:
        return self._find_failures()

    def batches(self) -> Iterator[pa.RecordBatch]:
        """The rows as Arrow batches of the spec's batch size, without holding them all."""
        return stream_batches(self.rows, self.batch_size)


def load_table(
    source: DataFrame,
    schema: T.StructType,
    rows_per_partition: int = 0,
    *,
    key: str = "id",
    parallelism: int | None = None,
    on_error: str = "fail",
    null_keys: str = "drop",
    ordered: bool = False,
    with_index: bool = False,
    check_utf8: bool = False,
    rule: str | None = None,
    bounds: Callable[[], tuple[int, int] | None] | None = None,
) -> Loaded:
    """Load any DataFrame through the range plan of its key, in a single scan.

    N range reads over one set of files would be N scans, so the range of a row is a
    computed column instead, and one that only a range index or healing asks for: any
    other load needs no bounds. ``bounds`` saves the pass that finds them.
    """

    def plan() -> RangePlan | None:
        column = source.columns[queries.key_position(source.schema, key)]
        found = bounds() if bounds else queries.key_bounds(source, column)
        cores = parallelism or default_parallelism(source.sparkSession)
        return make_plan(found, cores, rows_per_partition)

    options = LoadOptions(key, on_error, null_keys, ordered, with_index, check_utf8, rule)
    return _finish(source, schema, cache(plan), options)


def load_parquet(
    spark: SparkSession, path: str, schema: T.StructType, columns: list[str] | None = None, **options
) -> Loaded:
    """:func:`load_table` of Parquet files, with key bounds taken from the footers.

    ``columns`` picks and orders the source columns; the rest are never read.
    """
    files = spark.read.parquet(path)
    key = options.get("key", "id")
    return load_table(
        files.select(*columns) if columns else files,
        schema,
        bounds=lambda: queries.parquet_key_bounds(spark, path, key, files.schema),
        **options,
    )


def load(
    spark: SparkSession,
    spec: LoadSpec | dict | str,
    rows_per_partition: int = 0,
    *,
    key: str = "id",
    parallelism: int | None = None,
    on_error: str = "fail",
    null_keys: str = "drop",
    ordered: bool = False,
    with_index: bool = False,
    check_utf8: bool = False,
    rule: str | None = None,
    max_connections: int | None = None,
    max_statements: int = MAX_STATEMENTS,
    split_by: str | None = None,
    splits: int = 1,
    landing: str | None = None,
    unreadable: str = "fail",
    max_failed: int | None = None,
) -> Loaded:
    """Load the query of a spec (an object, a dict or a YAML path).

    ``rows_per_partition``: 0 or less tunes the range width from the key span, a
    positive number sets it. ``on_error``: ``"fail"`` stops at the first value that
    does not fit, ``"null_partition"`` turns its range into NULL rows, ``"safe"`` turns
    the value alone into NULL. ``rule`` is an SQL condition that marks further rows as bad.
    ``max_connections`` caps the statements that a database runs at a time;
    ``max_statements`` is how many there may be, finer plans being read in runs of
    adjacent ranges (``Loaded.plan`` stays the plan that was set). ``split_by`` and ``splits`` divide each of its ranges by a second integer,
    for keys that repeat a lot. Rows come unordered unless ``ordered``. Healing, and any
    landing, runs the source once and reads what it wrote.

    With ``landing``, a folder all executors share, ranges land there one by one: a range
    whose connection fails is healed like one with bad values, and a load that is started
    again goes on where it ended (:mod:`rangeloom.operators.land`). A database is read that
    way, in a folder of its own, wherever ranges are healed or connections capped. A range
    that cannot be read becomes NULL rows under ``"null_partition"``; under ``"safe"`` it ends
    the load unless ``unreadable="null_rows"``. ``max_failed`` bounds how many there may be.
    """
    spec = as_spec(spec)
    options = dict(
        key=key, on_error=on_error, null_keys=null_keys, ordered=ordered,
        with_index=with_index, check_utf8=check_utf8, rule=rule,
    )
    if landing or not spec.runs_on_session and (max_connections or on_error == "null_partition"):
        from rangeloom.operators.land import load_landed

        return load_landed(
            spark, spec, landing or scratch_path(spark, "landing"), rows_per_partition, parallelism=parallelism,
            connections=max_connections or 8, split_by=split_by, splits=splits, unreadable=unreadable,
            max_failed=max_failed, **options,
        )
    cores = parallelism or default_parallelism(spark)
    if spec.runs_on_session:
        source = queries.query_as_source(spark, spec.query)
        loaded = load_table(source, spec.schema, rows_per_partition, parallelism=cores, **options)
        loaded.batch_size = spec.batch_size
        return loaded
    plan = make_plan(jdbc.jdbc_key_bounds(spark, spec, key), cores, rows_per_partition)
    if plan is None:
        source = jdbc.jdbc_schema(spark, spec)
    else:
        source = jdbc.read_ranges(
            spark, spec, plan, key, max_statements, null_keys == "keep",
            split_by, splits,
        )
    loaded = _finish(source, spec.schema, lambda: plan, LoadOptions(**options))
    loaded.batch_size = spec.batch_size
    return loaded


def _finish(
    source: DataFrame,
    schema: T.StructType,
    get_plan: Callable[[], RangePlan | None],
    options: LoadOptions,
) -> Loaded:
    position = queries.key_position(source.schema, options.key)
    named = rename_by_position(source, schema)
    key = schema.names[position]
    if INDEX in map(str.lower, schema.names):
        raise ValueError(f"'{INDEX}' is the range index; give the column another name")
    if options.ordered:
        if not isinstance(schema[position].dataType, (T.LongType, T.IntegerType)):
            raise ValueError(f"rows can be ordered by '{key}' only if it is declared an integer")
        named = with_row_tag(named)

    plan = get_plan() if options.with_index or options.heals else None
    if plan is None and options.heals and options.null_keys == "keep":
        plan = NO_KEYS
    if options.rule is not None and options.on_error == "fail":
        refused = f"raise_error({sql_text(f'refused by rule: {options.rule}')})"
        named = named.where(f"CASE WHEN {options.rule} THEN CAST({refused} AS BOOLEAN) ELSE true END")
    if plan is not None:
        rows = with_partition(named, key, plan, options.null_keys == "keep")
    else:  # the range does not matter, or there are no keys at all
        rows = named if options.null_keys == "keep" else named.where(f"{quoted(key)} IS NOT NULL")
        rows = rows.selectExpr("*", f"CAST(NULL AS BIGINT) AS {INDEX}")

    if options.heals and plan is not None:
        rows, report = heal.heal_partitions(
            rows, schema, key, plan, options.rule, options.check_utf8
        )
        find_failures = lambda: report
    else:
        mode = "strict" if options.on_error == "fail" else "safe"
        kept = [INDEX, ROW_TAG] if options.ordered else [INDEX]
        rows = bind_types(rows, schema, mode, kept, options.check_utf8)
        find_failures = partial(_failures, named, schema, key, get_plan, options)
    if options.ordered:
        # Ranges follow the key, so the key alone orders them, save for NULL rows,
        # which stand where their range does. The tag breaks ties, so that one repeated
        # key can be sorted by several tasks.
        rows = rows.orderBy(*[INDEX] * options.heals, quoted(key), ROW_TAG)
    chosen = rows.select(*[INDEX] * options.with_index, *map(quoted, schema.names))
    return Loaded(chosen, get_plan, find_failures)


def _failures(
    named: DataFrame,
    schema: T.StructType,
    key: str,
    get_plan: Callable[[], RangePlan | None],
    options: LoadOptions,
) -> DataFrame | None:
    if options.on_error != "safe":
        return None
    keep = options.null_keys == "keep"
    plan = get_plan() or (NO_KEYS if keep else None)
    if plan is None:
        return None
    ranged = with_partition(named, key, plan, keep)
    return heal.judge(ranged, schema, key, plan, options.rule, options.check_utf8).report


def empty_result(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, with the declared columns."""
    return spark.createDataFrame([], schema)
