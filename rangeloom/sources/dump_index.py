"""A sidecar for dump files: where blocks of whole rows lie, how many rows, and which keys.

It is written once, by a job over the exact splits of the files. After that a scan needs no
search for rows, a range of keys opens only the blocks that can hold some of it, and the
files are a relation: ``spark.read.format("rangeloom_dump")``, of which only the columns of
the read's schema are decoded and, on request, filters on the key pick blocks.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rangeloom.functions.names import quoted
from rangeloom.plans.ranges import default_parallelism
from rangeloom.sources.dump import SPLIT_BYTES, TASK_BYTES, _decode_spans, count_tasks, decode_span, dump_files, dump_splits
from rangeloom.sources.dump_codec import DumpError, RowCodec
from rangeloom.sources.store import append_file, locate, open_file, qualified

#: Bytes of a block; what a range scan reads is whole blocks.
BLOCK_BYTES = 8 << 20

FORMAT = "rangeloom_dump"

_BLOCK = (
    "path string, length bigint, start bigint, stop bigint, rows bigint, least bigint, greatest bigint, null_keys bigint"
)


def write_index(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    key: str,
    index: str,
    block_bytes: int = BLOCK_BYTES,
    mode: str = "strict",
) -> str:
    """Write the index of the dump files at ``path`` to the new folder ``index``.

    Per block: the file and its length, the bytes, the rows, the least and the greatest key
    and the number of NULL keys. Values are checked as ``mode`` has it, so an index of
    damaged files is not written. ``key`` must be declared an integer.
    """
    if not isinstance(schema[key].dataType, (T.LongType, T.IntegerType)):
        raise ValueError(f"key '{key}' must be declared an integer")
    index, safe, place = qualified(spark, index).rstrip("/"), mode == "safe", schema.names.index(key)
    files = dump_files(spark, path)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = RowCodec(schema, safe)
        for batch in batches:
            lines = []
            for name, length, start, stop in zip(*(c.to_pylist() for c in batch.columns)):
                rows, nulls, least, greatest = 0, 0, None, None
                for found in decode_span(name, start, stop, codec):
                    keys = found.column(place)
                    rows, nulls = rows + found.num_rows, nulls + keys.null_count
                    seen = pc.min_max(keys).as_py()
                    if seen["min"] is not None:
                        least = seen["min"] if least is None else min(least, seen["min"])
                        greatest = seen["max"] if greatest is None else max(greatest, seen["max"])
                lines.append((name, length, start, stop, rows, least, greatest, nulls))
            kinds = (pa.string(), *[pa.int64()] * 7)
            names = ("path", "length", "start", "stop", "rows", "least", "greatest", "null_keys")
            columns = zip(*lines) if lines else [()] * len(kinds)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    tasks = count_tasks(files, block_bytes)
    # The blocks of a file come from one task; they are dealt out to be read.
    spans = dump_splits(files, schema, block_bytes, tasks, mode).repartition(tasks)
    lines = spans.select("path", "length", "start", "stop").mapInArrow(describe, _BLOCK)
    # Not by range: that would read all blocks twice, the first time for a sample.
    lines.repartition(max(1, default_parallelism(spark) // 4)).sortWithinPartitions("path", "start").write.parquet(f"{index}/blocks")
    note = {"schema": schema.json(), "key": key, "mode": mode}
    append_file(spark, f"{index}/about.json", json.dumps(note))
    return index


class _About:
    """What an index says of itself."""

    def __init__(self, index: str):
        with open_file(f"{index}/about.json") as source:
            note = json.loads(source.read())
        self.schema = T.StructType.fromJson(json.loads(note["schema"]))
        self.key, self.mode = note["key"], note["mode"]


def read_range(
    spark: SparkSession, index: str, lo: int, hi: int, columns: list[str] | None = None
) -> DataFrame:
    """Rows of the indexed files with ``lo <= key <= hi``; no other blocks are opened.

    ``columns`` are those to decode, all if None.
    """
    index = qualified(spark, index).rstrip("/")
    about = _About(index)
    wanted = columns or about.schema.names
    decoded = wanted if about.key in wanted else [*wanted, about.key]
    blocks = spark.read.schema(_BLOCK).parquet(f"{index}/blocks")
    chosen = blocks.where((F.col("least") <= F.lit(hi)) & (F.col("greatest") >= F.lit(lo)))
    # A block lies between its start and the next one's, or the file's end.
    size = chosen.agg(F.sum(F.coalesce("stop", "length") - F.col("start"))).first()[0] or 0
    tasks = max(1, -(-size // SPLIT_BYTES), min(size // BLOCK_BYTES, 4 * default_parallelism(spark)))
    found = _decode_spans(chosen.select("path", "start", "stop").repartition(tasks), about.schema, about.mode, decoded)
    return found.where(F.col(quoted(about.key)).between(lo, hi)).select(*map(quoted, wanted))


class Span(D.InputPartition):
    """Runs of whole rows that one task reads."""

    def __init__(self, spans: list[tuple[str, int, int | None]]):
        self.spans = spans


class DumpReader(D.DataSourceReader):
    def __init__(self, index: str, schema: T.StructType, split_bytes: int, push: bool, tasks: int):
        self.index, self.split_bytes, self.push, self.tasks = index, split_bytes, push, tasks
        self.about = _About(index)
        self.only = schema.names
        declared = {f.name: f.dataType for f in self.about.schema.fields}
        for field in schema.fields:
            if declared.get(field.name) != field.dataType:
                raise DumpError(f"column '{field.name}' is not declared {field.dataType.simpleString()} in {index}")
        self.lo, self.hi = -(2**63), 2**63 - 1
        self.not_null = False

    def pushFilters(self, filters):
        """Bounds of the key pick blocks; Spark still tests the rows."""
        for f in filters if self.push else ():
            if getattr(f, "attribute", None) != (self.about.key,):
                continue
            value = getattr(f, "value", None)
            if isinstance(f, (D.EqualTo, D.GreaterThanOrEqual)):
                self.lo = max(self.lo, value)
            if isinstance(f, (D.EqualTo, D.LessThanOrEqual)):
                self.hi = min(self.hi, value)
            if isinstance(f, D.GreaterThan):
                self.lo = max(self.lo, value + 1)
            if isinstance(f, D.LessThan):
                self.hi = min(self.hi, value - 1)
            if isinstance(f, D.In) and value:
                self.lo, self.hi = max(self.lo, min(value)), min(self.hi, max(value))
            self.not_null |= isinstance(f, (D.EqualTo, D.GreaterThan, D.GreaterThanOrEqual, D.LessThan, D.LessThanOrEqual, D.In, D.IsNotNull))
        return filters

    def partitions(self):
        store, place = locate(f"{self.index}/blocks")
        blocks = ds.dataset(place, filesystem=store, format="parquet")
        may = (ds.field("least") <= self.hi) & (ds.field("greatest") >= self.lo)
        if not self.not_null:
            may |= ds.field("null_keys") > 0
        found = blocks.to_table(columns=["path", "length", "start", "stop"], filter=may).sort_by([("path", "ascending"), ("start", "ascending")])
        total = pc.sum(pc.subtract(pc.coalesce(found.column("stop"), found.column("length")), found.column("start"))).as_py() or 0
        most = max(self.split_bytes, min(TASK_BYTES, total // self.tasks))
        parts, size = [], most
        for path, length, start, stop in zip(*(found.column(c).to_pylist() for c in ("path", "length", "start", "stop"))):
            end = length if stop is None else stop
            if size + end - start > most:
                parts.append(Span([]))
                size = 0
            spans, size = parts[-1].spans, size + end - start
            if spans and spans[-1][0] == path and spans[-1][2] == start:
                spans[-1] = (path, spans[-1][1], stop)  # blocks side by side are read as one
            else:
                spans.append((path, start, stop))
        return parts or [Span([])]

    def read(self, partition):
        codec = RowCodec(self.about.schema, self.about.mode == "safe", self.only)
        for span in partition.spans:
            yield from decode_span(*span, codec)


class DumpSource(D.DataSource):
    """Indexed dump files as a relation.

    Options: ``path``, the index; ``split_bytes``, what a task reads; ``tasks``, beyond which
    a task reads more, up to ``TASK_BYTES``; ``push``, whether filters
    pick blocks (see :func:`dump_relation`). A schema given to the reader names the columns
    wanted, with their declared types; only those are decoded.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return _About(self.options["path"].rstrip("/")).schema

    def reader(self, schema: T.StructType) -> DumpReader:
        options = self.options
        return DumpReader(
            options["path"].rstrip("/"), schema, int(options.get("split_bytes", SPLIT_BYTES)), options.get("push") == "true",
            int(options.get("tasks", 1_024)),
        )


def register_source(spark: SparkSession) -> None:
    """Make :class:`DumpSource` known to the session, with filters offered to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DumpSource)


def dump_relation(
    spark: SparkSession,
    index: str,
    columns: list[str] | None = None,
    split_bytes: int = SPLIT_BYTES,
    for_one_query: bool = False,
) -> DataFrame:
    """The indexed files as a relation, of some or all columns; usable as a view in SQL.

    With ``for_one_query``, filters on the key pick the blocks that are opened. Spark keeps
    the filters it has pushed with the relation and not with the query, so such a relation
    must be used once, in one place of one query; :func:`read_range` has no such limit.
    """
    register_source(spark)
    index = qualified(spark, index).rstrip("/")
    reader = spark.read.format(FORMAT).option("split_bytes", split_bytes).option("push", str(for_one_query).lower())
    reader = reader.option("tasks", 4 * default_parallelism(spark))
    if columns:
        declared = _About(index).schema
        reader = reader.schema(T.StructType([declared[c] for c in columns]))
    return reader.load(index)
