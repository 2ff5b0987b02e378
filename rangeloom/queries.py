"""Every operator as a query over the driver's tables, with the SQL it must match.

Queries take ``(spark, folder of Parquet tables)``. The number of cores a plan is
tuned for is fixed, so that results do not depend on the machine.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rangeloom.functions import epoch
from rangeloom.functions.casts import text_is_valid
from rangeloom.functions.types import struct_of
from rangeloom.operators.bind import positional_bind, rename_by_position
from rangeloom.operators.counts import partition_counts, with_partition
from rangeloom.operators.heal import (
    failed_partitions,
    heal_partitions,
    mark_rerun,
    safe_rerun,
)
from rangeloom.operators import sinks
from rangeloom.operators.land import load_landed, most_at_once, read_landing, read_log
from rangeloom.operators.layout import analyze_table, range_layout
from rangeloom.operators.load import load, load_parquet, load_table
from rangeloom.operators.packing import pack_batches
from rangeloom.operators.profile import decode_profile, first_rows_in_files, null_profile
from rangeloom.operators.report import timed_load
from rangeloom.plans import ranges
from rangeloom.plans.ranges import RangePlan, make_plan
from rangeloom.plans.row_ranges import make_row_plan, row_counts
from rangeloom.plans.session import JOB_ERRORS, cause_of, scratch_path, set_aside
from rangeloom.sources import queries as sources
from rangeloom.sources.dump import (
    blob_status,
    decode_blobs,
    decode_files,
    encode_blobs,
    heal_blobs,
    write_dumps,
)
from rangeloom.sources.dump_codec import RowCodec, wrap
from rangeloom.sources.dump_index import dump_relation, read_range, write_index
from rangeloom.sources.synth import series, synth_columns

CORES = 4

# Small enough that the dump files of the queries are read in several splits.
DUMP_SPLIT_BYTES = 1 << 20
# Rows of a dump file laid out by key; four files at least.
DUMP_FILE_ROWS = 1_000_000

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _register(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` (its own if none) with the SQL it must match."""

    def add(query: Query) -> Query:
        QUERIES[name or query.__name__] = query
        ORACLES[name or query.__name__] = sql
        return query

    return add


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return sources.full_scan(spark, _path(folder, name))


def _path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.parquet"


def _plan(spark: SparkSession, folder: str, name: str, key: str, width: int = 0) -> RangePlan:
    return make_plan(sources.parquet_key_bounds(spark, _path(folder, name), key), CORES, width)


ORDER_COLUMNS = [
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
]
ORDER_SCHEMA = struct_of([
    ("id", "Int64"),
    ("customer_id", "Int32"),
    ("status", "Utf8"),
    ("total_price", "Float64"),
    ("ordered_at", "Timestamp(Nanosecond, None)"),
    ("priority", "Utf8"),
])
_ORDER_SELECT = """
    o_orderkey AS id, CAST(o_custkey AS INTEGER) AS customer_id, o_orderstatus AS status,
    o_totalprice AS total_price, o_orderdate AS ordered_at, o_orderpriority AS priority"""



def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return load_parquet(
        spark, _path(folder, "orders"), ORDER_SCHEMA, ORDER_COLUMNS,
        key="o_orderkey", parallelism=CORES, with_index=True,
    ).rows


# -- bounds, width, plan, counts


@_register(
    """SELECT min(l_orderkey) AS lo, max(l_orderkey) AS hi,
              max(l_orderkey) - min(l_orderkey) + 1 AS span FROM lineitem"""
)
def key_bounds(spark, folder):
    lineitem = _table(spark, folder, "lineitem")
    return sources.bounds_frame(lineitem, "l_orderkey").withColumn("span", F.expr("hi - lo + 1"))


@_register(
    """SELECT min(l_orderkey) AS lo, max(l_orderkey) AS hi,
              max(l_orderkey) - min(l_orderkey) + 1 AS span FROM lineitem"""
)
def footer_bounds(spark, folder):
    files = sources.footer_frame(spark, _path(folder, "lineitem"))
    return files.selectExpr("min(l_orderkey) AS lo", "max(l_orderkey) AS hi").withColumn("span", F.expr("hi - lo + 1"))


@_register(
    """WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders),
            w AS (SELECT lo, hi, greatest((hi - lo + 1) // 16, 10000) AS width FROM b)
       SELECT lo, hi, hi - lo + 1 AS span, width,
              (hi - lo + width) // width AS n_partitions FROM w"""
)
def autotune_width(spark, folder):
    bounds = sources.bounds_frame(_table(spark, folder, "orders"), "o_orderkey")
    return ranges.tuned_frame(bounds, CORES)


@_register(
    """WITH b AS (SELECT min(o_orderkey) AS a, max(o_orderkey) AS z FROM orders),
            p AS (SELECT unnest(range(0, (z - a) // 1000 + 1)) AS i, a, z FROM b)
       SELECT i AS partition_index, a + i * 1000 AS lo, least(a + i * 1000 + 999, z) AS hi,
              least(a + i * 1000 + 999, z) - (a + i * 1000) + 1 AS expected_rows FROM p"""
)
def partition_plan(spark, folder):
    return _plan(spark, folder, "orders", "o_orderkey", 1000).frame(spark)


_COUNTS_SQL = """
    WITH b AS (SELECT min({key}) AS a, max({key}) AS z FROM {table}),
         p AS (SELECT unnest(range(0, (z - a) // {width} + 1)) AS i, a, z FROM b),
         c AS (SELECT ({key} - a) // {width} AS i, count(*) AS n FROM {table}, b GROUP BY 1)
    SELECT p.i AS partition_index, a + p.i * {width} AS lo,
           least(a + p.i * {width} + {width} - 1, z) AS hi,
           least(a + p.i * {width} + {width} - 1, z) - (a + p.i * {width}) + 1 AS expected_rows,
           CAST(coalesce(n, 0) AS BIGINT) AS rows_read
    FROM p LEFT JOIN c ON c.i = p.i"""


@_register(_COUNTS_SQL.format(table="lineitem", key="l_orderkey", width=100), "partition_counts")
def partition_counts_repeated_keys(spark, folder):
    plan = _plan(spark, folder, "lineitem", "l_orderkey", 100)
    return partition_counts(_table(spark, folder, "lineitem"), "l_orderkey", plan)


@_register(_COUNTS_SQL.format(table="labels", key="doc_id", width=100))
def partition_counts_sparse_keys(spark, folder):
    plan = _plan(spark, folder, "labels", "doc_id", 100)
    return partition_counts(_table(spark, folder, "labels"), "doc_id", plan)



def _pack_sql(table: str, key: str, width: int, target: int, per_worker: int) -> str:
    counts = _COUNTS_SQL.format(table=table, key=key, width=width)
    return f"""
    WITH RECURSIVE counts AS ({counts}),
    ranges AS (SELECT partition_index AS i, partition_index // {per_worker} AS worker, rows_read AS n
               FROM counts),
    fold AS (
        SELECT worker, i, i AS first_i, n AS pending FROM ranges WHERE i % {per_worker} = 0
        UNION ALL
        SELECT r.worker, r.i,
               CASE WHEN f.pending >= {target} THEN r.i ELSE f.first_i END,
               CASE WHEN f.pending >= {target} THEN r.n ELSE f.pending + r.n END
        FROM fold f JOIN ranges r ON r.worker = f.worker AND r.i = f.i + 1),
    last_i AS (SELECT worker, max(i) AS i FROM ranges GROUP BY worker)
    SELECT f.worker AS worker, f.first_i AS first_partition, f.i AS last_partition,
           CAST(f.pending AS BIGINT) AS "rows", f.pending < {target} AS leftover
    FROM fold f JOIN last_i l ON l.worker = f.worker
    WHERE f.pending >= {target} OR (f.i = l.i AND f.pending > 0)"""


@_register(_pack_sql("labels", "doc_id", 50, 64, 1_000_000_000), "pack_batches")
def pack_batches_one_worker(spark, folder):
    plan = _plan(spark, folder, "labels", "doc_id", 50)
    counts = partition_counts(_table(spark, folder, "labels"), "doc_id", plan)
    return pack_batches(counts, 64)


@_register(_pack_sql("lineitem", "l_orderkey", 20, 700, 64))
def pack_batches_many_workers(spark, folder):
    plan = _plan(spark, folder, "lineitem", "l_orderkey", 20)
    counts = partition_counts(_table(spark, folder, "lineitem"), "l_orderkey", plan)
    return pack_batches(counts, 700, partitions_per_worker=64)



def _equal_rows(spark, folder, name: str, key: str, rows: int) -> DataFrame:
    """How the ranges of a plan by rows cover a table, and whether all hold about equally many."""
    table = _table(spark, folder, name)
    plan = make_row_plan(table, key, CORES, rows)
    found = row_counts(table, key, plan)
    even = F.max("rows_read") <= 1.05 * plan.rows / plan.n_partitions
    ahead = F.lead("lo").over(Window.orderBy("lo"))
    lined = found.withColumn("joined", F.coalesce(ahead == F.col("hi") + 1, F.lit(True)))
    return lined.agg(
        F.count("*").alias("n_ranges"), F.sum("rows_read").alias("rows"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.min("joined").alias("joined"), even.alias("even"),
    )


_EQUAL_SQL = """SELECT CAST(ceil(count(*) / {rows}.0) AS BIGINT) AS n_ranges, count(*) AS "rows", min({key}) AS lo, max({key}) AS hi,
                       true AS joined, true AS even FROM {table}"""


@_register(_EQUAL_SQL.format(table="lineitem", key="l_orderkey", rows=1000))
def row_ranges(spark, folder):
    return _equal_rows(spark, folder, "lineitem", "l_orderkey", 1000)


@_register(_EQUAL_SQL.format(table="labels", key="doc_id", rows=40))
def row_ranges_sparse_keys(spark, folder):
    return _equal_rows(spark, folder, "labels", "doc_id", 40)


@_register(
    """SELECT CAST(count(*) FILTER (o_orderkey % 3 = 0) AS BIGINT) AS hot_rows, CAST(1 AS BIGINT) AS hot_keys,
              CAST(count(*) AS BIGINT) AS "rows" FROM orders"""
)
def row_ranges_hot_key(spark, folder):
    """A key with a third of all rows is a range of its own."""
    middle = sum(sources.parquet_key_bounds(spark, _path(folder, "orders"), "o_orderkey")) // 2 // 3 * 3
    key = F.when(F.col("o_orderkey") % 3 == 0, F.lit(middle)).otherwise(F.col("o_orderkey")).alias("k")
    table = _table(spark, folder, "orders").select(key)
    counts = row_counts(table, "k", make_row_plan(table, "k", CORES, 100))
    alone = F.col("lo") == F.lit(middle)
    return counts.agg(
        F.sum(F.when(alone, F.col("rows_read"))).alias("hot_rows"),
        F.max(F.when(alone, F.col("hi") - F.col("lo") + 1)).alias("hot_keys"), F.sum("rows_read").alias("rows"),
    )


# -- loads and scans


@_register(
    f"""WITH b AS (SELECT min(o_orderkey) AS a, max(o_orderkey) AS z FROM orders)
        SELECT (o_orderkey - a) // greatest((z - a + 1) // 16, 10000) AS partition_index,
        {_ORDER_SELECT} FROM orders, b"""
)
def partitioned_load(spark, folder):
    return flagship(spark, folder)


@_register("SELECT * FROM orders")
def full_scan(spark, folder):
    return _table(spark, folder, "orders")


@_register(
    """SELECT c_mktsegment AS segment, o_orderstatus AS status, count(*) AS n_orders,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"""
)
def query_as_source(spark, folder):
    return sources.query_as_source(
        spark,
        f"""COPY (SELECT c_mktsegment AS segment, o_orderstatus AS status, count(*) AS n_orders,
                 CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
          FROM parquet.`{_path(folder, "orders")}` JOIN parquet.`{_path(folder, "customer")}`
               ON o_custkey = c_custkey
          GROUP BY ALL) TO STDOUT (FORMAT binary)""",
    )


@_register(
    """WITH b AS (SELECT min(l_orderkey) AS a, max(l_orderkey) AS z FROM lineitem)
       SELECT lineitem.* FROM lineitem, b
       WHERE l_orderkey BETWEEN a + (z - a + 1) // 4 AND z - (z - a + 1) // 4"""
)
def range_slice(spark, folder):
    plan = _plan(spark, folder, "lineitem", "l_orderkey")
    quarter = plan.span // 4
    middle = F.col("l_orderkey").between(plan.lo + quarter, plan.hi - quarter)
    return _table(spark, folder, "lineitem").where(middle)


def _orders_with_null_keys(spark, folder):
    orders = _table(spark, folder, "orders").select(*ORDER_COLUMNS)
    key = F.when(F.col("o_orderkey") % 100 != 7, F.col("o_orderkey"))
    return orders.withColumn("o_orderkey", key)


@_register(f"SELECT {_ORDER_SELECT} FROM orders WHERE o_orderkey % 100 <> 7")
def null_key_drop(spark, folder):
    source = _orders_with_null_keys(spark, folder)
    return load_table(source, ORDER_SCHEMA, 1000, key="o_orderkey").rows


@_register(
    f"""SELECT {_ORDER_SELECT} FROM (SELECT * REPLACE (
            CASE WHEN o_orderkey % 100 <> 7 THEN o_orderkey END AS o_orderkey) FROM orders)"""
)
def null_key_keep(spark, folder):
    source = _orders_with_null_keys(spark, folder)
    return load_table(source, ORDER_SCHEMA, 1000, key="o_orderkey", null_keys="keep").rows


@_register(f"SELECT {_ORDER_SELECT} FROM orders WHERE false")
def empty_source(spark, folder):
    source = _table(spark, folder, "orders").select(*ORDER_COLUMNS).where("false")
    return load_table(source, ORDER_SCHEMA, key="o_orderkey").rows


@_register(
    f"""WITH b AS (SELECT min(o_orderkey) AS a FROM orders)
        SELECT (o_orderkey - a) // 1000 AS partition_index, {_ORDER_SELECT} FROM orders, b"""
)
def ordered_concat(spark, folder):
    return load_parquet(
        spark, _path(folder, "orders"), ORDER_SCHEMA, ORDER_COLUMNS,
        key="o_orderkey", rows_per_partition=1000, ordered=True, with_index=True,
    ).rows


# -- binding, casts, scalar functions


@_register(
    """SELECT c_custkey AS a, c_name AS b, c_nationkey AS c, CAST(c_acctbal AS FLOAT) AS d,
              c_mktsegment AS e FROM customer""",
    "positional_bind",
)
def positional_bind_customer(spark, folder):
    columns = zip("abcde", ("Int64", "Utf8", "Int32", "Float32", "String"))
    return positional_bind(_table(spark, folder, "customer"), struct_of(columns))


EVENT_SCHEMA = struct_of([
    ("id", "Int64"),
    ("kind", "Utf8"),
    ("score", "Float32"),
    ("is_even", "Boolean"),
    ("seen_at", "Timestamp(Nanosecond, None)"),
    ("user_id", "Int32"),
    ("seen_on", "Date32"),
    ("rating", "Float64"),
])


@_register(
    """SELECT CAST(event_id AS BIGINT) AS id, CAST(event_type AS VARCHAR) AS kind,
              CAST(value AS FLOAT) AS score, event_id % 2 = 0 AS is_even,
              CAST(ts AS TIMESTAMP) AS seen_at, CAST(user_id AS INTEGER) AS user_id,
              CAST(ts AS DATE) AS seen_on, CAST(value AS DOUBLE) AS rating FROM events"""
)
def typed_projection(spark, folder):
    events = _table(spark, folder, "events").select(
        "event_id", "event_type", "value", (F.col("event_id") % 2 == 0).alias("even"),
        "ts", "user_id", F.col("ts").alias("on"), F.col("value").alias("again"),
    )
    return positional_bind(events, EVENT_SCHEMA)


@_register(
    """SELECT event_id, epoch_us(ts) - 946684800000000 AS micros,
              CAST(date_diff('day', DATE '2000-01-01', CAST(ts AS DATE)) AS INTEGER) AS days,
              ts AS back, CAST(ts AS DATE) AS back_day FROM events"""
)
def pg_epoch(spark, folder):
    events = _table(spark, folder, "events").select(
        "event_id",
        epoch.timestamp_to_micros(F.col("ts")).alias("micros"),
        epoch.date_to_days(F.col("ts").cast("date")).alias("days"),
    )
    return events.select(
        "*",
        epoch.micros_to_timestamp(F.col("micros")).alias("back"),
        epoch.days_to_date(F.col("days")).alias("back_day"),
    )


@_register("SELECT o_orderkey, o_orderkey % 3 <> 0 AS flag FROM orders")
def byte_bool(spark, folder):
    byte = (F.col("o_orderkey") % 3).cast("tinyint")
    return _table(spark, folder, "orders").select("o_orderkey", epoch.byte_to_boolean(byte).alias("flag"))


@_register("SELECT doc_id, doc_id % 7 <> 3 AS valid FROM documents")
def utf8_check(spark, folder):
    raw = F.encode("text", "UTF-8")
    cut = F.when(F.col("doc_id") % 7 == 3, F.concat(raw, F.lit(b"\xc3"))).otherwise(raw)
    return _table(spark, folder, "documents").select("doc_id", text_is_valid(cut).alias("valid"))


def _dirty_events(spark, folder) -> DataFrame:
    """Events as text, some fields of which hold something else than their type."""

    def text(value: Column, modulus: int, at: int) -> Column:
        return F.when(F.col("event_id") % modulus == at, F.col("event_type")).otherwise(
            value.cast("string")
        )

    return _table(spark, folder, "events").select(
        "event_id",
        text(F.col("user_id"), 5, 1).alias("user_id"),
        text(F.col("value"), 7, 2).alias("value"),
        text(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), 11, 3).alias("ts"),
        text(F.date_format("ts", "yyyy-MM-dd"), 13, 4).alias("day"),
        text(F.col("event_id") % 2 == 0, 17, 5).alias("even"),
    )


DIRTY_SCHEMA = struct_of([
    ("event_id", "Int64"),
    ("user_id", "Int32"),
    ("value", "Float64"),
    ("ts", "Timestamp(Nanosecond, None)"),
    ("day", "Date32"),
    ("even", "Boolean"),
])
_DIRTY_SELECT = """
    event_id, CASE WHEN event_id % 5 <> 1 THEN CAST(user_id AS INTEGER) END AS user_id,
    CASE WHEN event_id % 7 <> 2 THEN value END AS value,
    CASE WHEN event_id % 11 <> 3 THEN date_trunc('second', ts) END AS ts,
    CASE WHEN event_id % 13 <> 4 THEN CAST(ts AS DATE) END AS day,
    CASE WHEN event_id % 17 <> 5 THEN event_id % 2 = 0 END AS even"""


@_register(f"SELECT {_DIRTY_SELECT} FROM events")
def safe_cast(spark, folder):
    return positional_bind(_dirty_events(spark, folder), DIRTY_SCHEMA, "safe")


@_register(f"SELECT {_ORDER_SELECT} FROM orders")
def strict_cast(spark, folder):
    """All columns from their texts."""
    text = _table(spark, folder, "orders").select(*[F.col(c).cast("string") for c in ORDER_COLUMNS])
    return positional_bind(text, ORDER_SCHEMA)


@_register("SELECT 'column ''customer_id'': ''bad'' is not Int32' AS error FROM orders LIMIT 1")
def fatal_error(spark, folder):
    """The error that ends a load of orders with a value that does not fit."""
    customer = F.when(F.col("o_orderkey") % 100 == 7, "bad").otherwise(F.col("o_custkey").cast("string"))
    source = _table(spark, folder, "orders").select(*ORDER_COLUMNS).withColumn("o_custkey", customer)
    try:
        load_table(source, ORDER_SCHEMA, key="o_orderkey").rows.write.format("noop").mode("overwrite").save()
    except JOB_ERRORS as error:
        said = cause_of(error)
    return spark.createDataFrame([(said[said.index("column"):said.index("Int32") + 5],)], "error string")


# -- profiles

_NULL_MODULI = {"ts": 3, "user_id": 5, "event_type": 7, "value": 11, "props": 13}


def _with_nulls(events: DataFrame) -> DataFrame:
    columns = [
        F.when(F.col("event_id") % m != 1, F.col(name)).alias(name) for name, m in _NULL_MODULI.items()
    ]
    return events.select("event_id", *columns)


def _events_with_nulls(spark, folder) -> DataFrame:
    return _with_nulls(_table(spark, folder, "events"))


NULLABLE_SCHEMA = struct_of([
    ("event_id", "Int64"),
    ("ts", "Timestamp(Nanosecond, None)"),
    ("user_id", "Int64"),
    ("event_type", "Utf8"),
    ("value", "Float64"),
    ("props", "Utf8"),
])


def _profile_sql(source: str, columns: dict[str, tuple[str, str]]) -> str:
    """``columns`` maps names to (is-NULL condition, failed-decode condition)."""
    lines = [
        f"""SELECT '{name}' AS column_name, count(*) AS "rows",
            count(*) FILTER ({null}) AS null_count"""
        + (f", count(*) FILTER ({failed}) AS decode_failures" if failed else "")
        + " FROM sampled"
        for name, (null, failed) in columns.items()
    ]
    return f"WITH sampled AS ({source}) " + " UNION ALL ".join(lines)


_ALL = "SELECT * FROM events"
_FIRST = "SELECT * FROM events ORDER BY event_id LIMIT 10000"
_NULLS = {"event_id": ("false", "")} | {n: (f"event_id % {m} = 1", "") for n, m in _NULL_MODULI.items()}
_DIRT = {"user_id": (5, 1), "value": (7, 2), "ts": (11, 3), "day": (13, 4), "even": (17, 5)}
_FAILS = {"event_id": ("false", "false")} | {
    n: (f"event_id % {m} = {at}", f"event_id % {m} = {at}") for n, (m, at) in _DIRT.items()
}


@_register(_profile_sql(_FIRST, _NULLS), "null_profile")
def null_profile_sample(spark, folder):
    return null_profile(_events_with_nulls(spark, folder), NULLABLE_SCHEMA, "event_id")


@_register(_profile_sql("SELECT * FROM events ORDER BY event_id LIMIT 777", _NULLS))
def null_profile_file_order(spark, folder):
    """The first rows as they stand in the files."""
    first = first_rows_in_files(_table(spark, folder, "events"), 777)
    return null_profile(_with_nulls(first), NULLABLE_SCHEMA, sample_rows=None)


@_register(_profile_sql(_ALL, _NULLS))
def null_profile_whole(spark, folder):
    return null_profile(_events_with_nulls(spark, folder), NULLABLE_SCHEMA, sample_rows=None)


@_register(_profile_sql(_FIRST, _FAILS), "decode_profile")
def decode_profile_sample(spark, folder):
    return decode_profile(_dirty_events(spark, folder), DIRTY_SCHEMA, "event_id")


@_register(_profile_sql(_ALL, _FAILS))
def decode_profile_whole(spark, folder):
    return decode_profile(_dirty_events(spark, folder), DIRTY_SCHEMA, sample_rows=None)



# -- failures

LABEL_SCHEMA = struct_of([("doc_id", "Int64"), ("quality", "Int32"), ("toxic", "Int32")])


def _bad_labels(spark, folder) -> tuple[DataFrame, RangePlan]:
    """Labels in ranges of 50 ids, with a quality that is no number here and there."""
    quality = F.when(F.col("doc_id") % 97 == 5, F.lit("n/a")).otherwise(F.col("quality").cast("string"))
    labels = _table(spark, folder, "labels").select("doc_id", quality.alias("quality"), "toxic")
    plan = _plan(spark, folder, "labels", "doc_id", 50)
    return with_partition(rename_by_position(labels, LABEL_SCHEMA), "doc_id", plan), plan


_BAD_LABELS = """
    b AS (SELECT min(doc_id) AS a, max(doc_id) AS z FROM labels),
    ranged AS (SELECT (doc_id - a) // 50 AS i, labels.* FROM labels, b),
    failed AS (SELECT i, count(*) AS n_bad, min(doc_id) AS first_bad FROM ranged
               WHERE doc_id % 97 = 5 GROUP BY i),
    report AS (SELECT i, a + i * 50 AS lo, least(a + i * 50 + 49, z) AS hi, n_bad, first_bad
               FROM failed, b)"""


@_register(
    f"""WITH {_BAD_LABELS}
        SELECT i AS partition_index, doc_id, quality, toxic FROM ranged
        WHERE i NOT IN (SELECT i FROM failed)
        UNION ALL
        SELECT i, NULL, NULL, NULL FROM (SELECT i, unnest(range(lo, hi + 1)) FROM report)""",
    "heal_partitions",
)
def heal_partitions_labels(spark, folder):
    named, plan = _bad_labels(spark, folder)
    return heal_partitions(named, LABEL_SCHEMA, "doc_id", plan)[0]



@_register(
    f"""WITH {_BAD_LABELS}
        SELECT i AS partition_index, lo, hi, hi - lo + 1 AS expected_rows, n_bad,
               'column ''quality'' is not Int32, first at doc_id ' || CAST(first_bad AS VARCHAR)
                   AS first_error FROM report""",
    "failed_partitions",
)
def failed_partitions_labels(spark, folder):
    named, plan = _bad_labels(spark, folder)
    return failed_partitions(named, LABEL_SCHEMA, "doc_id", plan)



@_register(
    f"""WITH {_BAD_LABELS}
        SELECT i AS partition_index, doc_id,
               CASE WHEN doc_id % 97 <> 5 THEN quality END AS quality, toxic,
               i IN (SELECT i FROM failed) AS rerun FROM ranged""",
    "safe_rerun",
)
def safe_rerun_labels(spark, folder):
    named, plan = _bad_labels(spark, folder)
    return mark_rerun(*safe_rerun(named, LABEL_SCHEMA, "doc_id", plan))



def _bad_orders(spark, folder) -> DataFrame:
    customer = F.when(F.col("o_orderkey") % 2503 == 11, F.lit("none")).otherwise(
        F.col("o_custkey").cast("string")
    )
    return _table(spark, folder, "orders").select(*ORDER_COLUMNS).withColumn("o_custkey", customer)


@_register(
    f"""WITH b AS (SELECT min(o_orderkey) AS a, max(o_orderkey) AS z FROM orders),
             ranged AS (SELECT (o_orderkey - a) // 500 AS i, orders.* FROM orders, b),
             failed AS (SELECT DISTINCT i FROM ranged WHERE o_orderkey % 2503 = 11)
        SELECT {_ORDER_SELECT} FROM ranged WHERE i NOT IN (SELECT i FROM failed)
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, NULL, NULL FROM (
            SELECT unnest(range(a + i * 500, least(a + i * 500 + 499, z) + 1)) FROM failed, b)"""
)
def on_error_null_partition(spark, folder):
    source = _bad_orders(spark, folder)
    return load_table(source, ORDER_SCHEMA, 500, key="o_orderkey", on_error="null_partition").rows


@_register(
    f"""SELECT {_ORDER_SELECT.replace("CAST(o_custkey AS INTEGER)",
        "CASE WHEN o_orderkey % 2503 <> 11 THEN CAST(o_custkey AS INTEGER) END")} FROM orders"""
)
def on_error_safe(spark, folder):
    source = _bad_orders(spark, folder)
    return load_table(source, ORDER_SCHEMA, 500, key="o_orderkey", on_error="safe").rows


@_register(
    """SELECT event_id AS id, CAST(ts AS TIMESTAMP) AS seen_at, CAST(ts AS DATE) AS seen_on FROM events"""
)
def zoned_timestamp(spark, folder):
    """Instants, which are read at UTC in any session zone."""
    events = _table(spark, folder, "events").selectExpr("event_id", "ts")
    seconds = "CAST(CAST(ts - timestamp_ntz'1970-01-01 00:00:00' AS INTERVAL SECOND) AS DECIMAL(20, 6))"
    instant = F.expr(f"timestamp_micros(CAST({seconds} * 1000000 AS BIGINT))")
    schema = struct_of([("id", "Int64"), ("seen_at", "Timestamp(Nanosecond, None)"), ("seen_on", "Date32")])
    return positional_bind(events.select("event_id", instant.alias("at"), instant.alias("on")), schema)


@_register(
    """SELECT l_orderkey AS id,
              CASE WHEN l_linenumber % 3 <> 1 THEN CAST(l_extendedprice AS FLOAT) END AS price FROM lineitem"""
)
def float_overflow_safe(spark, folder):
    """A finite double that only an infinite float could stand for does not fit."""
    lines = _table(spark, folder, "lineitem")
    price = F.when(F.col("l_linenumber") % 3 == 1, F.lit(1e300)).otherwise(F.col("l_extendedprice"))
    return positional_bind(
        lines.select("l_orderkey", price), struct_of([("id", "Int64"), ("price", "Float32")]), mode="safe"
    )


@_register(
    """SELECT event_id, CASE WHEN event_id % 5 <> 2 THEN date '2000-01-01' + CAST(event_id AS INTEGER) END AS day,
              event_id % 5 <> 2 AS in_time FROM events"""
)
def pg_epoch_safe(spark, folder):
    """Infinities, and values too late for the type, become NULL in safe mode."""
    late = F.col("event_id") % 5 == 2
    days = F.when(late, F.lit(2**31 - 2)).otherwise(F.col("event_id"))
    micros = F.when(late, F.lit(2**63 - 2)).otherwise(F.col("event_id"))
    return _table(spark, folder, "events").select(
        "event_id", epoch.days_to_date(days, safe=True).alias("day"),
        epoch.micros_to_timestamp(micros, safe=True).isNotNull().alias("in_time"),
    )


_BAD_NULL_KEY = "o_orderkey % 100 = 7 AND o_custkey % 5 = 1"


def _orders_bad_at_null_keys(spark, folder):
    """Orders of which every hundredth has no key, some of those with a value that does not fit."""
    source = _orders_with_null_keys(spark, folder)
    fits = F.col("o_orderkey").isNotNull() | (F.col("o_custkey") % 5 != 1)
    return source.withColumn("o_custkey", F.when(fits, F.col("o_custkey").cast("string")).otherwise("bad"))


@_register(
    f"""WITH bad AS (SELECT count(*) FILTER ({_BAD_NULL_KEY}) AS n FROM orders)
        SELECT * FROM (SELECT {_ORDER_SELECT} FROM orders WHERE o_orderkey % 100 <> 7)
        UNION ALL
        SELECT NULL AS id, CASE WHEN n = 0 THEN CAST(o_custkey AS INTEGER) END, CASE WHEN n = 0 THEN o_orderstatus END,
               CASE WHEN n = 0 THEN o_totalprice END, CASE WHEN n = 0 THEN o_orderdate END,
               CASE WHEN n = 0 THEN o_orderpriority END
        FROM orders, bad WHERE o_orderkey % 100 = 7"""
)
def heal_null_keys(spark, folder):
    """NULL keys are a range of their own: as many NULL rows as it had rows."""
    source = _orders_bad_at_null_keys(spark, folder)
    return load_table(
        source, ORDER_SCHEMA, 1000, key="o_orderkey", on_error="null_partition", null_keys="keep"
    ).rows


@_register(
    f"""SELECT CAST(NULL AS BIGINT) AS partition_index, count(*) AS n_bad,
               'column ''customer_id'' is not Int32, at a NULL key' AS first_error,
               (SELECT count(*) FROM orders WHERE o_orderkey % 100 = 7) AS expected_rows
        FROM orders WHERE {_BAD_NULL_KEY} HAVING count(*) > 0"""
)
def safe_failures_null_keys(spark, folder):
    source = _orders_bad_at_null_keys(spark, folder)
    loaded = load_table(source, ORDER_SCHEMA, 1000, key="o_orderkey", on_error="safe", null_keys="keep")
    return loaded.failures.select("partition_index", "n_bad", "first_error", "expected_rows")


@_register(
    f"""WITH o AS (SELECT count(*) AS n, count(*) FILTER (o_orderkey % 100 = 7) AS k,
                          count(*) FILTER ({_BAD_NULL_KEY}) AS c FROM orders)
        SELECT unnest(['id', 'customer_id', 'status', 'total_price', 'ordered_at', 'priority']) AS column_name,
               n AS "rows", unnest([k, c, 0, 0, 0, 0]) AS null_count FROM o"""
)
def null_profile_null_keys(spark, folder):
    """A profile of all rows, those without a key among them."""
    source = _orders_bad_at_null_keys(spark, folder)
    return null_profile(source, ORDER_SCHEMA, "o_orderkey", source.count())


# -- landing, tables


def _orders_spec(folder: str, customer: str) -> dict:
    columns = ", ".join([c for c in ORDER_COLUMNS if c != "o_custkey"][1:])
    query = f"SELECT o_orderkey AS id, {customer} AS customer_id, {columns} FROM parquet.`{_path(folder, 'orders')}`"
    schema = [
        {"column_name": name, "arrow_type": kind}
        for name, kind in zip(ORDER_SCHEMA.names, ("Int64", "Int32", "Utf8", "Float64", "Timestamp(Nanosecond, None)", "Utf8"))
    ]
    return {"connection_string": "spark", "query": query, "schema": schema}


# A text in place of one customer's number, in the first range.
_HURT = "if(o_orderkey = (SELECT min(o_orderkey) + 7 FROM parquet.`{orders}`), 'bad', CAST(o_custkey AS STRING))"


def _land(spark, folder: str, customer: str, **options):
    spec = _orders_spec(folder, customer.format(orders=_path(folder, "orders")))
    return load_landed(
        spark, spec, scratch_path(spark, "landing"), 2_500, parallelism=CORES, **options
    )


@_register(f"SELECT {_ORDER_SELECT} FROM orders")
def landed_load(spark, folder):
    return _land(spark, folder, "o_custkey").rows


@_register(
    f"""WITH b AS (SELECT min(o_orderkey) AS a, max(o_orderkey) AS z FROM orders)
        SELECT {_ORDER_SELECT} FROM orders, b WHERE o_orderkey > a + 2499
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, NULL, NULL
        FROM (SELECT unnest(range(0, least(z - a + 1, 2500))) FROM b)"""
)
def landed_heal(spark, folder):
    """One scan lands all; only the range with the bad value becomes NULL rows."""
    return _land(spark, folder, _HURT).rows


@_register(
    f"""WITH b AS (SELECT min(o_orderkey) AS a FROM orders)
        SELECT {_ORDER_SELECT.replace("CAST(o_custkey AS INTEGER)",
        "CASE WHEN o_orderkey <> a + 7 THEN CAST(o_custkey AS INTEGER) END")} FROM orders, b"""
)
def landed_safe(spark, folder):
    """The range that fails is read again value by value."""
    return _land(spark, folder, _HURT, on_error="safe").rows


@_register(
    """SELECT CAST(0 AS BIGINT) AS partition_index, min(o_orderkey) AS lo,
              least(min(o_orderkey) + 2499, max(o_orderkey)) AS hi FROM orders"""
)
def landed_safe_list(spark, folder):
    return _land(spark, folder, _HURT, on_error="safe").failures.select("partition_index", "lo", "hi")


# Reading fails at one key of the second range, in any policy and however often it is tried.
_LOST = """if(o_orderkey = (SELECT min(o_orderkey) + 2507 FROM parquet.`{orders}`),
               CAST(raise_error('connection lost') AS STRING), """ + _HURT + ")"
_SAFE_ORDERS = _ORDER_SELECT.replace(
    "CAST(o_custkey AS INTEGER)", "CASE WHEN o_orderkey <> a + 7 THEN CAST(o_custkey AS INTEGER) END"
)
_LOST_ROWS = """
    SELECT NULL, NULL, NULL, NULL, NULL, NULL
    FROM (SELECT unnest(range(0, greatest(0, least(z - a - 2499, 2500)))) FROM b)"""
_BOUNDS_SQL = "WITH b AS (SELECT min(o_orderkey) AS a, max(o_orderkey) AS z FROM orders)"


@_register(
    f"""{_BOUNDS_SQL} SELECT {_ORDER_SELECT} FROM orders, b WHERE o_orderkey > a + 4999
        UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL FROM (SELECT unnest(range(0, least(z - a + 1, 5000))) FROM b)"""
)
def landed_unreadable(spark, folder):
    """A range with a bad value and one that cannot be read: both become NULL rows."""
    return _land(spark, folder, _LOST).rows


@_register(
    f"""{_BOUNDS_SQL} SELECT {_SAFE_ORDERS} FROM orders, b WHERE o_orderkey NOT BETWEEN a + 2500 AND a + 4999
        UNION ALL {_LOST_ROWS}"""
)
def landed_safe_unreadable(spark, folder):
    """What can be read is decoded value by value, what cannot becomes NULL rows: no row is lost."""
    return _land(spark, folder, _LOST, on_error="safe", unreadable="null_rows").rows


@_register(f"{_BOUNDS_SQL} SELECT {_SAFE_ORDERS} FROM orders, b")
def landed_resume(spark, folder):
    """A landing that healed, read again from its log alone, under another policy."""
    return read_landing(spark, _land(spark, folder, _HURT).landing, on_error="safe").rows


@_register(
    f"""{_BOUNDS_SQL} SELECT CAST(0 AS BIGINT) AS partition_index, a AS lo, least(a + 2499, z) AS hi,
               least(2500, z - a + 1) AS expected_rows, CAST(1 AS BIGINT) AS n_bad,
               'column ''customer_id'' is not Int32, first at id ' || CAST(a + 7 AS VARCHAR) AS first_error FROM b
        UNION ALL SELECT 1, a + 2500, least(a + 4999, z), least(2500, z - a - 2499), NULL, 'connection lost' FROM b WHERE z >= a + 2507"""
)
def landed_resume_failures(spark, folder):
    """The failures of a landing as its log has them."""
    found = read_landing(spark, _land(spark, folder, _LOST).landing).failures
    lost = F.when(F.col("n_bad").isNull(), F.regexp_extract("first_error", "connection lost", 0))
    return found.withColumn("first_error", F.coalesce(lost, "first_error"))


@_register(
    """SELECT least(8, CAST(ceil((max(o_orderkey) - min(o_orderkey) + 1) / 100.0) AS BIGINT)) AS n_slices, count(*) AS "rows", true AS within
       FROM orders"""
)
def capped_readers(spark, folder):
    """A landing in eight slices, two of which are read at a time, by the times in its log."""
    spec = _orders_spec(folder, "o_custkey")
    made = load_landed(spark, spec, scratch_path(spark, "landing"), 100, parallelism=CORES, max_slices=8, connections=2)
    lines = read_log(spark, made.landing)
    found = lines.agg(F.count("*").alias("n_slices"), F.sum("rows").alias("rows"))
    return found.withColumn("within", F.lit(most_at_once(lines) <= 2))


@_register("SELECT count(*) AS \"rows\", 6 AS n_columns, CAST(ceil((max(o_orderkey) - min(o_orderkey) + 1) / 1000.0) AS BIGINT) AS n_ranges FROM orders")
def load_report(spark, folder):
    """Rows counted in passing by a timed load, with its columns and ranges."""
    def make():
        return load_parquet(
            spark, _path(folder, "orders"), ORDER_SCHEMA, ORDER_COLUMNS, key="o_orderkey", rows_per_partition=1000, parallelism=CORES
        )

    seen = timed_load(make)
    return spark.createDataFrame([(seen.rows, len(seen.columns), seen.n_partitions)], "rows bigint, n_columns int, n_ranges bigint")


def _new_table(spark) -> tuple[str, str]:
    """A name no other run has, and a folder that is deleted when the driver ends."""
    return f"rangeloom_{uuid.uuid4().hex}", scratch_path(spark, "table")


@_register(f"SELECT {_ORDER_SELECT} FROM orders")
def insert_select(spark, folder):
    """A table created with the declared columns and filled by position."""
    name, path = _new_table(spark)
    sinks.create_table(spark, name, ORDER_SCHEMA, path=path)
    try:
        sinks.insert_select(positional_bind(_table(spark, folder, "orders").select(*ORDER_COLUMNS), ORDER_SCHEMA), name)
        return spark.read.schema(ORDER_SCHEMA).parquet(path)
    finally:
        spark.sql(f"DROP TABLE {name}")


@_register(
    """SELECT unnest(['id', 'customer_id']) AS column_name, unnest([min(o_orderkey), min(o_custkey)]) AS least,
              unnest([max(o_orderkey), max(o_custkey)]) AS greatest, CAST(0 AS BIGINT) AS nulls, count(*) AS "rows" FROM orders"""
)
def table_statistics(spark, folder):
    """What the catalog knows of a table after it was analysed."""
    name, path = _new_table(spark)
    sinks.create_table(spark, name, ORDER_SCHEMA, path=path)
    try:
        sinks.insert_select(positional_bind(_table(spark, folder, "orders").select(*ORDER_COLUMNS), ORDER_SCHEMA), name)
        analyze_table(spark, name, ["id", "customer_id"])
        whole = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
        rows = int(whole["Statistics"].split(" bytes, ")[1].split(" ")[0])
        lines = []
        for column in ("id", "customer_id"):
            known = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {name} {column}").collect()}
            lines.append((column, int(known["min"]), int(known["max"]), int(known["num_nulls"]), rows))
    finally:
        spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame(lines, "column_name string, least bigint, greatest bigint, nulls bigint, rows bigint")


@_register(
    """SELECT batch, count(*) AS n, min(o_orderkey) AS first_id, max(o_orderkey) AS last_id FROM (
         SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 4096 AS batch FROM orders) GROUP BY batch"""
)
def streamed_batches(spark, folder):
    """What a consumer of an ordered load sees: batches of a fixed size, in the order of the key."""
    spec = _orders_spec(folder, "o_custkey") | {"batch_size": 4096}
    stream = load(spark, spec, ordered=True, parallelism=CORES).batches()
    # A partition's last batch may be short: the consumer counts rows, and keeps the keys only.
    ids = np.concatenate([np.empty(0, np.int64), *[batch.column("id").to_numpy() for batch in stream]])
    lines = [(k // 4096, len(ids[k : k + 4096]), int(ids[k]), int(ids[k : k + 4096][-1])) for k in range(0, len(ids), 4096)]
    return spark.createDataFrame(lines, "batch bigint, n bigint, first_id bigint, last_id bigint")


_BY_STATUS = "SELECT o_orderstatus AS status, count(*) AS n, min(o_orderkey) AS first_id, max(o_orderkey) AS last_id FROM orders GROUP BY ALL"


def _by_status(spark, folder) -> DataFrame:
    """A result of a few rows, whatever the table."""
    loaded = load_parquet(spark, _path(folder, "orders"), ORDER_SCHEMA, ORDER_COLUMNS, key="o_orderkey").rows
    return loaded.groupBy("status").agg(F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


@_register(_BY_STATUS)
def arrow_result(spark, folder):
    return spark.createDataFrame(sinks.to_arrow(_by_status(spark, folder)))


@_register(_BY_STATUS)
def pandas_result(spark, folder):
    return spark.createDataFrame(sinks.to_pandas(sinks.to_arrow(_by_status(spark, folder))))


# -- binary dumps


@_register(f"SELECT {_ORDER_SELECT} FROM orders")
def dump_roundtrip(spark, folder):
    orders = positional_bind(_table(spark, folder, "orders").select(*ORDER_COLUMNS), ORDER_SCHEMA)
    return decode_blobs(encode_blobs(orders, ORDER_SCHEMA), ORDER_SCHEMA)


@_register(
    "SELECT event_id, "
    + ", ".join(f"CASE WHEN event_id % {m} <> 1 THEN {n} END AS {n}" for n, m in _NULL_MODULI.items())
    + " FROM events"
)
def dump_nulls(spark, folder):
    events = positional_bind(_events_with_nulls(spark, folder), NULLABLE_SCHEMA)
    return decode_blobs(encode_blobs(events, NULLABLE_SCHEMA), NULLABLE_SCHEMA)


DOCUMENT_SCHEMA = struct_of([
    ("doc_id", "Int64"), ("text", "Utf8"), ("lang", "Utf8"), ("source", "Utf8"), ("n_chars", "Int64"),
])


@_register("SELECT doc_id, text, lang, source, n_chars FROM documents")
def dump_texts(spark, folder):
    documents = positional_bind(
        _table(spark, folder, "documents").select(*DOCUMENT_SCHEMA.names), DOCUMENT_SCHEMA
    )
    return decode_blobs(encode_blobs(documents, DOCUMENT_SCHEMA), DOCUMENT_SCHEMA)


WHOLE_LINE = struct_of([
    ("l_orderkey", "Int64"), ("l_partkey", "Int64"), ("l_suppkey", "Int64"), ("l_linenumber", "Int32"),
    ("l_quantity", "Float64"), ("l_extendedprice", "Float64"), ("l_discount", "Float64"), ("l_tax", "Float64"),
    ("l_returnflag", "Utf8"), ("l_linestatus", "Utf8"), ("l_shipdate", "Timestamp(Nanosecond, None)"),
])


def _line_dumps(spark, folder) -> str:
    """All of lineitem as dump files in the shared folder."""
    target = scratch_path(spark, "dumps")
    write_dumps(positional_bind(_table(spark, folder, "lineitem").select(*WHOLE_LINE.names), WHOLE_LINE), target, WHOLE_LINE)
    return target


@_register("SELECT * FROM lineitem")
def dump_file_splits(spark, folder):
    """Dump files in the shared folder, read back in several splits per file."""
    return decode_files(spark, _line_dumps(spark, folder), WHOLE_LINE, split_bytes=DUMP_SPLIT_BYTES)


def _indexed_lines(spark, folder) -> str:
    """An index of lineitem as dump files laid out by key, in small blocks."""
    table = _table(spark, folder, "lineitem")
    n_files = max(4, table.count() // DUMP_FILE_ROWS)
    lines = range_layout(table, "l_orderkey", n_files).select(*WHOLE_LINE.names)
    target = scratch_path(spark, "dumps")
    write_dumps(positional_bind(lines, WHOLE_LINE), target, WHOLE_LINE)
    return write_index(spark, target, WHOLE_LINE, "l_orderkey", scratch_path(spark, "index"), DUMP_SPLIT_BYTES // 8)


_MIDDLE = "WITH b AS (SELECT (min(l_orderkey) + max(l_orderkey)) // 2 AS m FROM lineitem)"


@_register(f"{_MIDDLE} SELECT lineitem.* FROM lineitem, b WHERE l_orderkey BETWEEN m AND m + 499")
def dump_range(spark, folder):
    """A range of keys of dump files, from the blocks that can hold it."""
    lo, hi = sources.parquet_key_bounds(spark, _path(folder, "lineitem"), "l_orderkey")
    return read_range(spark, _indexed_lines(spark, folder), (lo + hi) // 2, (lo + hi) // 2 + 499)


@_register("SELECT * FROM lineitem")
def dump_source(spark, folder):
    """Dump files as a relation."""
    return dump_relation(spark, _indexed_lines(spark, folder), split_bytes=DUMP_SPLIT_BYTES)


@_register(
    """SELECT l_returnflag, count(*) AS n, min(l_orderkey) AS first_key, max(l_orderkey) AS last_key FROM lineitem
       WHERE l_orderkey >= 100 AND l_orderkey < (SELECT max(l_orderkey) FROM lineitem) GROUP BY l_returnflag"""
)
def dump_source_sql(spark, folder):
    """SQL over two columns of dump files; the filter on the key goes down to blocks."""
    _, last = sources.parquet_key_bounds(spark, _path(folder, "lineitem"), "l_orderkey")
    lines = dump_relation(spark, _indexed_lines(spark, folder), ["l_orderkey", "l_returnflag"], DUMP_SPLIT_BYTES, True)
    return spark.sql(
        """SELECT l_returnflag, count(*) AS n, min(l_orderkey) AS first_key, max(l_orderkey) AS last_key FROM {lines}
           WHERE l_orderkey >= 100 AND l_orderkey < {last} GROUP BY l_returnflag""", lines=lines, last=last,
    )


# Bytes of a row of two columns (a long and a text of one letter), all of which are ASCII.
_LIKE_A_ROW = b"\x00\x02\x00\x00\x00\x08ABCDEFGH\x00\x00\x00\x01z".decode()


@_register(
    f"""SELECT doc_id, CAST(CASE WHEN doc_id % 3 = 0 THEN {len(_LIKE_A_ROW)} * (1 + doc_id % 2000) ELSE length(text) END AS INTEGER) AS n_chars,
               true AS same FROM documents"""
)
def dump_row_like_texts(spark, folder):
    """Texts that read as rows themselves, in dump files read back in small splits."""
    kind = struct_of([("doc_id", "Int64"), ("text", "Utf8")])
    fake = F.repeat(F.lit(_LIKE_A_ROW), (1 + F.col("doc_id") % 2000).cast("int"))
    docs = _table(spark, folder, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, fake).otherwise(F.col("text")).alias("text"))
    target = scratch_path(spark, "dumps")
    write_dumps(docs, target, kind)
    found = decode_files(spark, target, kind, split_bytes=DUMP_SPLIT_BYTES // 16)
    # Spark takes the decoded rows for as small as their spans, and would broadcast all texts.
    both = found.join(docs.select("doc_id", F.col("text").alias("written")).hint("merge"), "doc_id")
    return both.select("doc_id", F.length("text").alias("n_chars"), (F.col("text") == F.col("written")).alias("same"))


@_register('SELECT CAST(count(*) AS BIGINT) AS "rows", CAST(0 AS BIGINT) AS failed FROM orders')
def dump_status(spark, folder):
    orders = positional_bind(_table(spark, folder, "orders").select(*ORDER_COLUMNS), ORDER_SCHEMA)
    status = blob_status(encode_blobs(orders, ORDER_SCHEMA), ORDER_SCHEMA)
    return status.agg(F.sum("rows").alias("rows"), F.count("error").alias("failed"))


_DUMP_KEY = "o_orderkey // 1000"


def _hurt_dumps(spark, folder):
    """Orders as dumps of a thousand keys each, every third cut off in its last row."""
    orders = positional_bind(_table(spark, folder, "orders").select(*ORDER_COLUMNS), ORDER_SCHEMA)
    number = F.floor(F.col("id") / 1000)
    parts = orders.withColumn("part", number).repartition("part")

    def encode(key, table):
        batch = table.drop_columns(["part"]).combine_chunks().to_batches()[0]
        content = wrap(RowCodec(ORDER_SCHEMA).encode(batch))
        if key[0].as_py() % 3 == 1:
            content = content[:-5]
        return pa.table({"path": [str(key[0].as_py())], "content": pa.array([content], pa.binary())})

    dumps = parts.groupBy("part").applyInArrow(encode, "path string, content binary")
    expected = orders.groupBy(number.cast("string").alias("path")).agg(F.count("*").alias("expected_rows"))
    return set_aside(dumps), expected


@_register(
    f"""SELECT {_ORDER_SELECT} FROM orders WHERE ({_DUMP_KEY}) % 3 <> 1
        UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL FROM orders WHERE ({_DUMP_KEY}) % 3 = 1"""
)
def dump_heal(spark, folder):
    """Dumps that are cut off become their expected number of NULL rows."""
    dumps, expected = _hurt_dumps(spark, folder)
    return heal_blobs(dumps, ORDER_SCHEMA, expected)[0]


@_register(
    f"""SELECT CAST({_DUMP_KEY} AS VARCHAR) AS path, ({_DUMP_KEY}) % 3 = 1 AS failed FROM orders GROUP BY ALL"""
)
def dump_blob_status(spark, folder):
    dumps, _ = _hurt_dumps(spark, folder)
    return blob_status(dumps, ORDER_SCHEMA).select("path", F.col("error").isNotNull().alias("failed"))


# -- generated rows, layout


@_register(
    """SELECT o_orderkey + 1 AS id, md5(CAST(o_orderkey + 1 AS VARCHAR)) AS uuid,
              'user_' || CAST(o_orderkey + 1 AS VARCHAR) AS username,
              (o_orderkey + 1) % 2 = 0 AS is_active,
              CASE WHEN (o_orderkey + 1) % 10 = 0 THEN NULL ELSE 'Sample notes' END AS notes,
              true AS in_range FROM orders"""
)
def synth_table(spark, folder):
    ids = _table(spark, folder, "orders").select((F.col("o_orderkey") + 1).alias("id"))
    in_range = (
        F.col("score").between(0, 100)
        & F.col("course_id").between(100, 110)
        & F.col("rating").between(0, 5)
        & F.expr("last_login BETWEEN timestamp_ntz'2024-01-01' AND timestamp_ntz'2025-01-01'")
        & F.expr("start_date BETWEEN date'2022-04-06' AND date'2025-01-01'")
    )
    return synth_columns(ids).select(
        "id", "uuid", "username", "is_active", "notes", in_range.alias("in_range")
    )


@_register("SELECT unnest(range(min(o_orderkey), max(o_orderkey) + 1)) AS id FROM orders")
def key_series(spark, folder):
    lo, hi = sources.parquet_key_bounds(spark, _path(folder, "orders"), "o_orderkey")
    return series(spark, lo, hi)


@_register("SELECT * FROM lineitem", "range_layout")
def range_layout_lineitem(spark, folder):
    return range_layout(_table(spark, folder, "lineitem"), "l_orderkey", 16)

