"""Streaming a loaded table to a consumer as Arrow batches of a chosen size.

Every task writes its batches to a file of the shared folder and gives it its name when it
is whole; what the job returns is a manifest of the files. The driver takes the files in the
order of the partitions, as soon as each is there: nothing is shuffled or sorted again, and
the first batches go out while later partitions are still computed.
"""

from __future__ import annotations

import threading
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from queue import Queue

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rangeloom.plans.session import scratch_path
from rangeloom.plans.spec import DEFAULT_BATCH_SIZE
from rangeloom.sources.store import locate, make_folder, qualified

# Bytes of batches that may wait for the consumer, and seconds between looks at the folder.
AHEAD_BYTES = 32 << 20
LOOK_SEC = 0.05

MANIFEST = "part bigint, batches bigint, rows bigint, bytes bigint"


def rebatch(batches: Iterable[pa.RecordBatch], batch_size: int) -> Iterator[pa.RecordBatch]:
    """Cut and join batches to exactly ``batch_size`` rows; the last may be shorter."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, batch_size - rows)
            batch = batch.slice(part.num_rows)
            held.append(part)
            rows += part.num_rows
            if rows == batch_size:
                yield _joined(held)
                held, rows = [], 0
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def write_batches_by_part(df: DataFrame, folder: str, batch_size: int) -> DataFrame:
    """Write the rows as one file of Arrow batches per partition; returns the manifest, not yet run.

    A file is named by its partition's number once it is whole, so a task that is run again
    does no harm.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        store, root = locate(folder)
        part = context.partitionId()
        draft, writer, n, rows = f"{root}/_draft-{context.taskAttemptId()}", None, 0, 0
        with store.open_output_stream(draft) as sink:
            for batch in rebatch(batches, batch_size):
                writer = writer or pa.ipc.new_stream(sink, batch.schema)
                writer.write_batch(batch)
                n, rows = n + 1, rows + batch.num_rows
            if writer:
                writer.close()
            size = sink.tell()
        store.move(draft, f"{root}/{_name(part)}")
        yield pa.RecordBatch.from_pydict({"part": [part], "batches": [n], "rows": [rows], "bytes": [size]})

    return df.mapInArrow(write, MANIFEST)


def _name(part: int) -> str:
    return f"part-{part:09d}.arrows"


class _Job:
    """The writing job, in a thread of its own; ``parts`` is its manifest once it is done."""

    def __init__(self, manifest: DataFrame):
        self.parts: dict[int, int] | None = None
        self.done = threading.Event()
        self._pool = ThreadPoolExecutor(1)
        self._future = self._pool.submit(self._run, manifest)

    def _run(self, manifest: DataFrame) -> None:
        try:
            self.parts = {row.part: row.bytes for row in manifest.collect()}
        finally:
            self.done.set()

    def check(self) -> None:
        if self.done.is_set():
            self._future.result()


def _files(folder: str, job: _Job) -> Iterator[str]:
    """The files in the order of the partitions, each as soon as it is there."""
    store, root = locate(folder)
    part = 0
    while True:
        job.check()
        path = f"{root}/{_name(part)}"
        over = job.done.is_set()
        if store.get_file_info(path).type.name == "File":
            yield path
            part += 1
        elif over:
            if job.parts is None or part > max(job.parts, default=-1):
                return
            part += 1  # a partition that made no file
        else:
            job.done.wait(LOOK_SEC)


def _read(store, path: str) -> Iterator[pa.RecordBatch]:
    with store.open_input_stream(path) as source:
        if not source.read(1):
            return
    with store.open_input_stream(path) as source, pa.ipc.open_stream(source) as reader:
        yield from reader
    store.delete_file(path)


class _Ahead:
    """Runs an iterator of batches in a thread, as far ahead as :data:`AHEAD_BYTES` allow."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        self.queue: Queue = Queue()
        self.room = threading.Condition()
        self.waiting, self.stopped = 0, False
        self.thread = threading.Thread(target=self._fill, args=(batches,), daemon=True)
        self.thread.start()

    def _fill(self, batches: Iterator[pa.RecordBatch]) -> None:
        try:
            for batch in batches:
                with self.room:
                    self.room.wait_for(lambda: self.stopped or self.waiting == 0 or self.waiting + batch.nbytes <= AHEAD_BYTES)
                    if self.stopped:
                        return
                    self.waiting += batch.nbytes
                self.queue.put(batch)
            self.queue.put(None)
        except BaseException as error:  # raised where the batches are consumed
            self.queue.put(error)

    def __iter__(self) -> Iterator[pa.RecordBatch]:
        try:
            while (item := self.queue.get()) is not None:
                if isinstance(item, BaseException):
                    raise item
                with self.room:
                    self.waiting -= item.nbytes
                    self.room.notify()
                yield item
        finally:
            with self.room:
                self.stopped = True
                self.room.notify()


def stream_batches(
    df: DataFrame, batch_size: int = DEFAULT_BATCH_SIZE, prefetch: bool = True
) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``batch_size`` rows, one Spark partition after the other, in its order.

    The driver holds a batch at a time, and with ``prefetch`` up to :data:`AHEAD_BYTES` of
    the next ones. Files are deleted as they are consumed, the rest when the driver ends. An
    error of the job is raised when the batches before it are consumed.
    """
    spark: SparkSession = df.sparkSession
    folder = qualified(spark, scratch_path(spark, "batches"))
    make_folder(spark, folder)
    job = _Job(write_batches_by_part(df, folder, batch_size))
    store, _ = locate(folder)
    batches = (batch for path in _files(folder, job) for batch in _read(store, path))
    yield from _Ahead(batches) if prefetch else batches
