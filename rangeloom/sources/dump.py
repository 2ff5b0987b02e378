"""Reading (and, for fixtures, writing) binary dumps with Spark.

Two inputs are taken: dumps held in a ``(path, content)`` DataFrame, and dump files
of any size. A large file is cut into splits. Rows have no separators, so a split cannot
know where its first one begins; it follows the rows from *every* place near its start
where one may begin, to where they leave it. Those exits, a few for each split, are all the
places where rows may enter a later one, which is read once more from these alone. Its
maps from entries to exits, taken in the order of the splits, give the true chain of rows,
whatever the texts in between look like.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rangeloom.operators.heal import null_rows
from rangeloom.operators.counts import INDEX
from rangeloom.plans.ranges import default_parallelism
from rangeloom.plans.session import cut_lineage
from rangeloom.sources.dump_codec import HEADER_BYTES, DumpError, RowCodec, decode_stream, read_header, wrap
from rangeloom.sources.store import empty_files, exists, locate, open_file, qualified

SPLIT_BYTES = 128 << 20
BLOCK_BYTES = 8 << 20
# A task reads several splits, up to so many bytes, if there are enough of them for all cores.
TASK_BYTES = 32 << 20
# Rows of a split are followed from all places in this many of its first bytes (where a row
# that is longer ends, the place is followed up later), in blocks of so many bytes.
WINDOW_BYTES = 1 << 20
WALK_BYTES = 1 << 20

BROADCAST_PATHS = 100_000

_STATUS = "path string, rows bigint, error string"


def _ddl(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


# -- dumps held in a DataFrame


def decode_blobs(dumps: DataFrame, schema: T.StructType, mode: str = "strict") -> DataFrame:
    """Rows of the dumps in a ``(path string, content binary)`` DataFrame."""
    safe = mode == "safe"

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = RowCodec(schema, safe)
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                yield from _named(path.as_py(), io.BytesIO(content.as_buffer()).read, codec)

    return dumps.select("path", "content").mapInArrow(decode, _ddl(schema))


def _named(path: str, read, codec: RowCodec, **parts) -> Iterator[pa.RecordBatch]:
    try:
        yield from decode_stream(read, codec, **parts)
    except DumpError as error:
        raise DumpError(f"{path}: {error}") from None


def blob_status(dumps: DataFrame, schema: T.StructType, mode: str = "strict") -> DataFrame:
    """``(path, rows, error)`` per dump: its row count, or why it cannot be decoded."""
    safe = mode == "safe"

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = RowCodec(schema, safe)
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                yield _status(path.as_py(), io.BytesIO(content.as_buffer()).read, codec)

    return dumps.select("path", "content").mapInArrow(check, _STATUS)


def _status(path: str, read, codec: RowCodec, **parts) -> pa.RecordBatch:
    rows, error = 0, None
    try:
        for batch in decode_stream(read, codec, **parts):
            rows += batch.num_rows
    except DumpError as problem:
        error = str(problem)
    return pa.RecordBatch.from_pydict(
        {"path": pa.array([path], pa.string()), "rows": [rows], "error": pa.array([error], pa.string())}
    )


# -- dump files


def dump_files(spark: SparkSession, path: str) -> DataFrame:
    """``(path, length)`` of the dump files; their contents are not read.

    Spark does not list files of zero bytes: :func:`decode_files` refuses a folder with
    such a dump, cut before its first byte, and :func:`file_status` reports it.
    """
    return spark.read.format("binaryFile").load(path).select("path", "length")


def count_tasks(files: DataFrame, split_bytes: int) -> int:
    """Tasks to read the files: one per split, or fewer if many files or splits are small."""
    cut = F.greatest(F.ceil(F.col("length") / F.lit(split_bytes)), F.lit(1))
    splits, total = files.agg(F.sum(cut), F.sum("length")).first()
    least = 4 * default_parallelism(files.sparkSession)
    return max(min(splits or 1, max(-(-(total or 0) // max(split_bytes, TASK_BYTES)), least)), 1)


def dump_splits(
    files: DataFrame,
    schema: T.StructType,
    split_bytes: int = SPLIT_BYTES,
    tasks: int | None = None,
    mode: str = "strict",
) -> DataFrame:
    """``(path, start, stop, length)``: runs of whole rows; ``stop`` is NULL at a file's end.

    Of a damaged file, the last run begins where the rows can no longer be followed from.
    """
    begins = F.sequence(
        F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split_bytes).cast("long")
    )
    cuts = files.select("path", "length", F.explode(begins).alias("begin"))
    safe, tasks = mode == "safe", tasks or count_tasks(files, split_bytes)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = RowCodec(schema, safe)
        for batch in batches:
            for path, length, begin in zip(*(c.to_pylist() for c in batch.columns)):
                with open_file(path) as source:
                    places = np.unique(_exits(source, codec, begin, min(begin + split_bytes, length), length)[1])
                if begin == 0:
                    places = np.append(places, 0)  # where the file's header is
                n = len(places)
                yield pa.record_batch(
                    [pa.array([path] * n, pa.string()), np.full(n, length), places // split_bytes * split_bytes, places],
                    names=["path", "length", "begin", "place"],
                )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = RowCodec(schema, safe)
        for batch in batches:
            for path, length, begin, places in zip(*(c.to_pylist() for c in batch.columns)):
                with open_file(path) as source:
                    starts, exits = _exits(source, codec, begin, min(begin + split_bytes, length), length, places)
                if begin == 0 and not len(starts):
                    starts, exits = [0], [None]
                n = len(starts)
                yield pa.record_batch(
                    [pa.array([path] * n, pa.string()), np.full(n, length), pa.array(starts, pa.int64()), pa.array(exits, pa.int64())],
                    names=["path", "length", "start", "stop"],
                )

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = RowCodec(schema, safe)
        path, length, at, far = None, 0, None, False  # far: the row before began beyond its split's window

        def beyond(limit: int | None) -> Iterator[tuple]:
            """Runs up to ``limit`` that no split knows, as a row before was not in its window; those of a file's end."""
            nonlocal at, far
            while far and (limit is None or at < limit):
                begin = at // split_bytes * split_bytes
                with open_file(path) as source:
                    exits = _exits(source, codec, begin, min(begin + split_bytes, length), length, [at])[1]
                if not len(exits):
                    break
                yield path, at, int(exits[0]), length
                at, far = int(exits[0]), at - begin >= WINDOW_BYTES
            if limit is None:
                yield path, at, None, length

        def lines(found: list[tuple]) -> pa.RecordBatch:
            columns = zip(*found) if found else [(), (), (), ()]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "start", "stop", "length"])

        for batch in batches:
            found = []
            for name, size, start, stop in zip(*(c.to_pylist() for c in batch.columns)):
                if name != path:
                    if path is not None:
                        found += beyond(None)
                    path, length, at, far = name, size, 0, False
                if start > at:
                    found += beyond(start)
                if start == at and stop is not None:
                    found.append((path, at, stop, length))
                    at, far = stop, start % split_bytes >= WINDOW_BYTES
            yield lines(found)
        if path is not None:
            yield lines(list(beyond(None)))

    exits = cuts.repartition(tasks).mapInArrow(follow, "path string, length bigint, begin bigint, place bigint")
    entries = exits.groupBy("path", "length", "begin").agg(F.collect_set("place").alias("places"))
    maps = entries.repartition(tasks).mapInArrow(walk, "path string, length bigint, start bigint, stop bigint")
    # A few numbers per split; a file's are read one after the other.
    ordered = maps.repartition("path").sortWithinPartitions("path", "start")
    return ordered.mapInArrow(chain, "path string, start bigint, stop bigint, length bigint")


def _exits(
    source: pa.NativeFile, codec: RowCodec, begin: int, end: int, length: int, at: int | list[int] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Starts of rows in a split, and where the rows from there leave it: the first start at or after ``end``.

    Rows are followed from ``at``, of which 0 is the file's header, or from the header and
    every possible start in the first :data:`WINDOW_BYTES`. Starts whose rows end before
    that, be it with the trailer, are left out.
    """
    parent: list[int] = []  # readers that met go on as one
    readers: dict[tuple[int, int], int] = {}  # (place, column, or -1 at a row's start) to reader
    origins: list[tuple[np.ndarray, np.ndarray]] = []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def put(state: tuple[int, int], reader: int | None = None) -> int:
        if state in readers:
            if reader is not None and reader != readers[state]:
                parent[reader] = readers[state]
            return readers[state]
        if reader is None:
            reader = len(parent)
            parent.append(reader)
        readers[state] = reader
        return reader

    def many(starts: np.ndarray, places: np.ndarray, columns: np.ndarray) -> None:
        if len(starts):
            many_of = len(codec.widths)
            states, which = np.unique(places * (many_of + 1) + np.where(columns == many_of, -1, columns) + 1, return_inverse=True)
            ids = [put((s // (many_of + 1), s % (many_of + 1) - 1)) for s in states.tolist()]
            origins.append((starts, np.array(ids, np.int64)[which]))

    first, every = begin, at is None
    places = [] if every else at if isinstance(at, list) else [at]
    if begin == 0 and (every or 0 in places):
        source.seek(0)
        try:
            first = read_header(source.read(HEADER_BYTES))
            origins.append((np.array([0]), np.array([put((first, -1))])))
        except DumpError:
            if every or len(places) == 1:
                return np.empty(0, np.int64), np.empty(0, np.int64)
    elif every and begin <= length - 2 < min(begin + WINDOW_BYTES, end):
        origins.append((np.array([length - 2]), np.array([put((length - 2, -1))])))
    for place in places:
        if place:
            origins.append((np.array([place]), np.array([put((place, -1))])))
    if not every:
        first = min((place for place, _ in readers), default=end)
    for a in range(first, end, WALK_BYTES):
        b = min(a + WALK_BYTES, end)
        fresh = every and a < begin + WINDOW_BYTES
        if not fresh and not any(a <= place < b for place, _ in readers):
            continue
        source.seek(a)
        data = source.read(min(b + 8, length) - a)
        starts, ends, cut = codec.chains(data)
        if fresh:
            new = starts < min(begin + WINDOW_BYTES, b) - a
            many(starts[new] + a, ends[new] + a, np.full(new.sum(), -1))
            new = cut[0] < min(begin + WINDOW_BYTES, b) - a
            many(cut[0][new] + a, cut[1][new] + a, cut[2][new])
        moving = [s for s in readers if s[0] < b]
        while moving:
            place, column = moving.pop()
            reader = readers.pop((place, column))
            at_next, column = _moved(codec, data, place - a, column, starts, ends)
            if at_next is None:
                continue
            state = (at_next + a, column)
            if state not in readers and state[0] < b:
                moving.append(state)
            put(state, reader)
    exit_of = np.full(len(parent) + 1, -1)
    for (place, column), reader in readers.items():
        while place is not None and column >= 0:  # the rest of a row that goes beyond the split
            source.seek(min(place, length))
            place, column = codec.next_place(column, source.read(4), place)
        if place is not None and end <= place < length:
            exit_of[reader] = place
    roots = np.array([*map(root, range(len(parent))), len(parent)])
    starts = np.concatenate([np.empty(0, np.int64), *[s for s, _ in origins]])
    exits = exit_of[roots[np.concatenate([np.empty(0, np.int64), *[ids for _, ids in origins]])]]
    return starts[exits >= 0], exits[exits >= 0]


def _moved(
    codec: RowCodec, data: bytes, at: int, column: int, starts: np.ndarray, ends: np.ndarray
) -> tuple[int | None, int]:
    """A reader's next place and column: along whole rows, else on to the next length."""
    if column >= 0:
        return codec.next_place(column, data[at : at + 4], at)
    i = np.searchsorted(starts, at)
    if i < len(starts) and starts[i] == at:
        return int(ends[i]), -1
    return (at + 2, 0) if data[at : at + 2] == codec.mark else (None, -1)


def decode_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    mode: str = "strict",
    split_bytes: int | None = SPLIT_BYTES,
) -> DataFrame:
    """Rows of dump files, any number of splits per file, in bounded memory per task.

    ``split_bytes=None`` reads each file in one task. A file of zero bytes is an error.
    Spark guesses the size of the rows from that of their spans, which is far too small: a
    join needs a ``merge`` hint, or it may broadcast them all.
    """
    if cut := empty_files(spark, path):
        raise DumpError(f"{cut[0]}: no bytes at all ({len(cut)} such files)")
    return _decode_spans(_spans(dump_files(spark, path), schema, split_bytes, mode), schema, mode)


def _spans(files: DataFrame, schema: T.StructType, split_bytes: int | None, mode: str = "strict") -> DataFrame:
    """``(path, start, stop)`` of what one task reads in one go, spread over tasks."""
    tasks = count_tasks(files, split_bytes or SPLIT_BYTES)
    if split_bytes is None:
        return files.selectExpr("path", "0L AS start", "CAST(NULL AS BIGINT) AS stop").repartition(tasks)
    return dump_splits(files, schema, split_bytes, tasks, mode).repartition(tasks)


def _decode_spans(
    spans: DataFrame, schema: T.StructType, mode: str, only: list[str] | None = None
) -> DataFrame:
    safe = mode == "safe"

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = RowCodec(schema, safe, only)
        for batch in batches:
            for span in zip(*(c.to_pylist() for c in batch.columns)):
                yield from decode_span(*span, codec)

    columns = [schema[name] for name in only] if only else schema.fields
    return spans.select("path", "start", "stop").mapInArrow(decode, _ddl(T.StructType(columns)))


def decode_span(path: str, start: int, stop: int | None, codec: RowCodec) -> Iterator[pa.RecordBatch]:
    """Rows of a run of whole rows of a file; ``stop`` is None at the file's end."""
    where = path if stop is None else f"{path}, bytes {start} to {stop}"
    with open_file(path) as source:
        yield from _named(where, _reader(source, start, stop), codec, **_parts(start, stop))


def _parts(start: int, stop: int | None) -> dict[str, bool]:
    return {"header": start == 0, "trailer": stop is None}


def _reader(source: pa.NativeFile, start: int, stop: int | None) -> Callable[[int], bytes]:
    """Read from ``start`` up to ``stop``, asking the store for large blocks."""
    source.seek(start)
    # The buffer is filled whole at once: no more of it than there is to read.
    left = (source.size() if stop is None else stop) - start
    blocks = pa.BufferedInputStream(source, max(1, min(BLOCK_BYTES, left)))
    at = start

    def read(n: int) -> bytes:
        nonlocal at
        data = blocks.read(n if stop is None else min(n, stop - at))
        at += len(data)
        return data

    return read


def file_status(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    mode: str = "strict",
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """``(path, rows, error)`` per dump file: its rows, or why it cannot be decoded and those before that."""
    safe = mode == "safe"

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = RowCodec(schema, safe)
        for batch in batches:
            for name, start, stop in zip(*(c.to_pylist() for c in batch.columns)):
                with open_file(name) as source:
                    yield _status(name, _reader(source, start, stop), codec, **_parts(start, stop))

    files = dump_files(spark, path)
    parts = _spans(files, schema, split_bytes, mode).select("path", "start", "stop").mapInArrow(check, _STATUS)
    cut = [(name, 0, "no bytes at all") for name in empty_files(spark, path)]
    whole = parts.groupBy("path").agg(F.sum("rows").alias("rows"), F.min("error").alias("error"))
    return whole.unionByName(spark.createDataFrame(cut, _STATUS))


def heal_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    expected: DataFrame,
    split_bytes: int = SPLIT_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """:func:`heal_blobs` for dump files; paths are written as :func:`dump_files` gives them."""
    status = cut_lineage(file_status(spark, path, schema, split_bytes=split_bytes))
    files = dump_files(spark, path)
    report = status.where("error IS NOT NULL").join(expected, "path", "left")
    _all_expected(report)
    chosen = files.join(status.where("error IS NULL").select("path"), "path", "left_semi")
    rows = _decode_spans(_spans(chosen, schema, split_bytes), schema, "strict")
    return rows.unionByName(_nulls_for(report, schema)), report.select("path", "expected_rows", "error")


def _all_expected(report: DataFrame) -> None:
    """A bad dump is replaced by a number of rows that somebody knows, or it is an error."""
    unknown = report.where("expected_rows IS NULL").select("path", "error").first()
    if unknown:
        raise DumpError(f"{unknown.path}: {unknown.error}; there is no expected number of rows for it")


def _nulls_for(report: DataFrame, schema: T.StructType) -> DataFrame:
    numbered = report.select(F.lit(0).cast("long").alias(INDEX), "expected_rows")
    return null_rows(numbered, schema).drop(INDEX)


def heal_blobs(
    dumps: DataFrame, schema: T.StructType, expected: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Replace each dump that cannot be decoded by its expected number of NULL rows.

    ``expected`` holds ``(path, expected_rows)``. Returns the rows and the report
    ``(path, expected_rows, error)``.
    """
    bad = blob_status(dumps, schema).where("error IS NOT NULL").select("path", "error")
    report = cut_lineage(bad.join(expected, "path", "left").select("path", "expected_rows", "error"))
    _all_expected(report)
    failed = report.select("path")
    if report.count() <= BROADCAST_PATHS:
        failed = F.broadcast(failed)  # else a shuffle on the path, which is unique
    good = dumps.join(failed, "path", "left_anti")
    return decode_blobs(good, schema).unionByName(_nulls_for(report, schema)), report


# -- writing, for fixtures


def encode_blobs(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows as dumps ``(path, content)``, one per Arrow batch (so of bounded size)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        codec = RowCodec(schema)
        part = TaskContext.get().partitionId()
        for i, batch in enumerate(batches):
            content = wrap(codec.encode(batch))
            yield pa.RecordBatch.from_pydict({"path": [f"part-{part:05d}-{i:05d}"], "content": [content]})

    return df.mapInArrow(encode, "path string, content binary")


def write_dumps(df: DataFrame, directory: str, schema: T.StructType) -> int:
    """Write one dump file per Spark partition into a shared folder; returns the rows.

    A file gets its name only when it is whole, so a task that is run again does no harm.
    The folder must be new: files of an earlier run would be read with these.
    """
    spark = df.sparkSession
    directory = qualified(spark, directory)
    if exists(spark, directory):
        raise FileExistsError(directory)
    store, root = locate(directory)
    store.create_dir(root)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        store, root = locate(directory)
        name = f"{root}/part-{context.partitionId():05d}.bin"
        draft = f"{root}/_draft-{context.taskAttemptId()}"
        codec, rows = RowCodec(schema), 0
        head, tail = wrap(b"")[:-2], wrap(b"")[-2:]
        with store.open_output_stream(draft) as sink:
            sink.write(head)
            for batch in batches:
                sink.write(codec.encode(batch))
                rows += batch.num_rows
            sink.write(tail)
        store.move(draft, name)
        yield pa.RecordBatch.from_pydict({"rows": [rows]})

    return df.mapInArrow(write, "rows bigint").agg(F.sum("rows")).first()[0] or 0
