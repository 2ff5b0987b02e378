"""Helpers shared by the operators: tables, words, hashes, connected components."""

from __future__ import annotations

import ctypes
import gc
import sys
import time
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.group import GroupedData

from rangeloom.plans.session import scratch_path
from rangeloom.sources.store import delete

#: Bytes of text in one Arrow batch sent to Python; a single longer text is a batch alone.
BATCH_BYTES = 4 << 20

#: Bytes of hashes that are counted together, in memory.
PART_BYTES = 8 << 20

Items = Callable[[list[bytes]], Iterator[np.ndarray]]

_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

#: ASCII capitals to small letters, all other bytes as they are.
LOWER_ASCII = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by bytes, so that long texts do not pile up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def worker_state() -> dict:
    """A dictionary that outlives a task in its Python worker, for what is costly to set up."""
    name = "__rangeloom_worker_state"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
    return vars(sys.modules[name])


def shared(spark: SparkSession, value: object) -> Callable[[], object]:
    """Broadcast a value that may be of a class of this package; tasks call what is returned.

    It travels as cloudpickle has it, with its class's code, so that workers need not have
    the package.
    """
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(sent.value)


def trim() -> None:
    """Give the memory of earlier batches back to the system; a Python worker lives long."""
    pa.default_memory_pool().release_unused()
    state = worker_state()
    if "trim" not in state:
        try:
            state["trim"] = ctypes.CDLL("libc.so.6").malloc_trim
        except (OSError, AttributeError):  # another C library
            state["trim"] = lambda _: None
    state["trim"](0)


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Texts of a new batch as UTF-8; null is empty."""
    trim()
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def mixed(values: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values, so that their order is as good as random."""
    v = values.copy()
    v ^= v >> np.uint64(30)
    v *= _MIX1
    v ^= v >> np.uint64(27)
    v *= _MIX2
    v ^= v >> np.uint64(31)
    return v


#: A random-looking factor per byte and per place in a word, for polynomial word hashes.
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * _MUL)
_PLACES = np.concatenate([[np.uint64(1)], np.cumprod(np.full(1023, _MIX1, np.uint64), dtype=np.uint64)])


def fold_table(keep: Callable[[int], bool], lower: bool) -> bytes:
    """A ``bytes.translate`` table: separators to a space, ASCII capitals to small letters if wanted."""
    return bytes((c if keep(c) else 32) for c in (LOWER_ASCII if lower else bytes(range(256))))


class Words:
    """The words of several texts: hashes, byte places, and where each text's words begin.

    ``fold`` maps the bytes of a text; what becomes a space separates words. Texts are
    hashed in chunks, so temporary arrays stay small however long a text is.
    """

    CHUNK = 1 << 20

    def __init__(self, texts: list[bytes], fold: bytes):
        joined = b" ".join(texts).translate(fold)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.text_at = np.cumsum(sizes + 1) - (sizes + 1)
        parts, a = [], 0
        while a < len(joined):
            b = joined.find(b" ", a + self.CHUNK)
            b = len(joined) if b < 0 else b
            parts.append(self._chunk(joined[a:b], a))
            a = b
        empty = (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))
        self.hashes, self.starts, self.ends = (np.concatenate(x) for x in zip(empty, *parts, strict=True))
        self.first = np.append(np.searchsorted(self.starts, self.text_at), len(self.starts))

    @staticmethod
    def _chunk(data: bytes, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        c = np.frombuffer(data, np.uint8)
        inside = np.zeros(len(c) + 2, np.int8)
        inside[1:-1] = c != 32
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        if not len(starts):
            return np.empty(0, np.uint64), starts, ends
        sizes = ends - starts
        begin = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum())) - np.repeat(begin, sizes)
        # Beyond the table's length places repeat, told apart by another factor.
        value = _BYTES[c[inside[1:-1].astype(bool)]] * _PLACES[place & 1023]
        if sizes.max() > 1024:
            value *= (place >> 10).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        return mixed(np.add.reduceat(value, begin) + sizes.astype(np.uint64)), starts + at, ends + at

    def of(self, k: int) -> slice:
        """The words of text ``k``, as a slice of the arrays."""
        return slice(int(self.first[k]), int(self.first[k + 1]))


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words that start at each position, for all full windows."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(length):
        total *= _MUL
        total += words[k : k + n]
    return mixed(total + np.uint64(length))


_COUNTED = pa.schema([("part", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())])


def _count_partly(batches: Iterator[pa.RecordBatch], items: Items, parts: int) -> Iterator[pa.RecordBatch]:
    """Documents per item within a batch, by ranges of the hash."""
    for batch in batches:
        found = list(items(texts_of(batch.column(1))))
        hashes, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *found]), return_counts=True)
        counts = np.minimum(counts, 2**32 - 1).astype(np.uint32)
        part = ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        cuts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(hashes)]])
        rows = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if a < b:  # counts of one, by far the most, are left out; those items come last
                several = counts[a:b] > 1
                own = np.concatenate([hashes[a:b][several], hashes[a:b][~several]])
                rows.append({"part": int(part[a]), "hashes": own.tobytes(), "counts": counts[a:b][several].tobytes()})
        yield pa.RecordBatch.from_pylist(rows, schema=_COUNTED)


def _count_fully(table: pa.Table, least: int) -> pa.Table:
    trim()
    hashes, counts = [], []
    for h, c in zip(table.column("hashes").to_pylist(), table.column("counts").to_pylist(), strict=True):
        own, several = np.frombuffer(h, np.uint64), np.frombuffer(c, np.uint32)
        hashes.append(own)
        counts.append(np.concatenate([several, np.ones(len(own) - len(several), np.uint32)]))
    hashes, counts = np.concatenate(hashes), np.concatenate(counts)
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    sums = np.add.reduceat(counts.astype(np.int64), first)
    many = sums >= least
    return pa.table({"s": hashes[first][many].view(np.int64), "documents": sums[many]})


def _counted(docs: DataFrame, items: Items) -> tuple[GroupedData, int]:
    """Partial counts of items by ranges of the hash, each of about :data:`PART_BYTES`."""
    size = docs.agg(F.sum(F.octet_length(docs.columns[1]))).first()[0] or 0
    parts = max(16, 2 * size // PART_BYTES)
    partly = docs.mapInArrow(lambda b: _count_partly(b, items, parts), "part bigint, hashes binary, counts binary")
    return partly.groupBy("part"), parts


def document_counts(docs: DataFrame, items: Items, least: int) -> DataFrame:
    """``(s, documents)`` of items (64-bit hashes) that at least ``least`` rows of ``docs`` have.

    ``items`` gives the distinct items of each text, the second column of ``docs``. They
    are counted as packed arrays: per batch first, so that a frequent item is one entry
    per batch, then by ranges of the hash.
    """
    groups, _ = _counted(docs, items)
    return groups.applyInArrow(lambda group: _count_fully(group, least), "s bigint, documents bigint")


def release(spark: SparkSession) -> None:
    """Let the driver drop the shuffle files of steps that are done and written.

    Spark deletes them when it finds, in collecting its garbage, that nothing refers to
    them; a driver with little to do may not come to that before the disks are full.
    """
    for _ in range(2):  # what the first round drops may hold on to more
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


#: Writer options for rows of megabytes. Parquet looks at the size of pages and row groups every
#: 100 rows only, and has room for a whole page twice more, outside the heap, to compress or read
#: it; a reader takes in a whole row group. Here it looks after each row, and ends one after four.
LARGE_ROWS = {"parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1, "parquet.block.row.count.limit": 4}


def write_once(df: DataFrame, large: bool = False, options: dict | None = None) -> DataFrame:
    """``df`` as Parquet in the shared folder: computed once, safe against lost executors.

    After a ``large`` step, whose shuffle files weigh, these are released. ``options`` are
    the writer's, such as :data:`LARGE_ROWS`.
    """
    path = scratch_path(df.sparkSession, "step")
    df.write.options(**options or {}).parquet(path)
    if large:
        release(df.sparkSession)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written.step_path = path
    return written


def discard(*written: DataFrame) -> None:
    """Delete steps of :func:`write_once` that nothing reads any more."""
    for df in written:
        delete(df.sparkSession, df.step_path)


def _spanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's links as stars: each node with the smallest one it reaches within the task."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    for k in range(0, len(nodes), 1 << 16):
        own = nodes[k : k + (1 << 16)]
        yield pa.record_batch([pa.array(own, pa.int64()), pa.array(map(root, own), pa.int64())], names=["u", "v"])


def spanning_links(links: DataFrame) -> DataFrame:
    """Links ``(u, v)`` with the same components, at most one per node and task.

    Dealt out by the larger end, twice: what a node reached in several tasks as the smaller
    end of links meets in one of them then. Each time a task holds its own nodes only, and
    no node has more rows than there are tasks.
    """
    stars = links.repartition("u").mapInArrow(_spanning, "u bigint, v bigint")
    return stars.repartition("u").mapInArrow(_spanning, "u bigint, v bigint")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node points at one other, which points at none."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    per_node = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return per_node.where("out > 1 OR out = 1 AND into = 1").isEmpty()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest reachable node of every node that has a link: ``(node, component)``.

    Each task first reduces its links to a spanning forest of them. Then follow rounds of
    pointing all neighbours of a node at the smallest of them (larger ones first, then
    smaller ones), which end after about log(diameter) rounds. The two steps of a round
    aggregate a minimum per node and join it back; both survive a node with very many
    links (partial aggregation, skew-join splitting).
    """
    apart = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    edges = write_once(spanning_links(apart.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))))
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(down, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("w")), F.struct(F.col("v").alias("u"), F.col("m").alias("w")))).alias("e"))
            .select(F.col("e.u").alias("u"), F.col("e.w").alias("v"))
            .where("u <> v")
            .distinct()
        )
        after = write_once(small)
        discard(edges)
        edges = after
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
