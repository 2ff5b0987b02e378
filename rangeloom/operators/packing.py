"""Packing whole ranges, in order, into batches, in parallel even for a single worker.

Where a batch ends depends on where it began, and so on all before it. Ranges are cut into
blocks; with the rows before a block known, a block can say for a batch that is still open
at its start ("cut where so many rows are reached") which batch will be open at its end.
That is done for all batches that any block may leave open; these answers are links, and
the ones on the true path from the worker's start are found by doubling the links' length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangeloom.operators.counts import INDEX
from rangeloom.plans.session import set_aside

#: Ranges of a block. The driver holds two numbers per block of a worker with several.
BLOCK_RANGES = 65_536

PACKED = "worker bigint, first_partition bigint, last_partition bigint, rows bigint, leftover boolean"
_PACKED = pa.schema([
    ("worker", pa.int64()), ("first_partition", pa.int64()), ("last_partition", pa.int64()), ("rows", pa.int64()),
    ("leftover", pa.bool_()),
])
_OPEN = pa.schema([("worker", pa.int64()), ("first", pa.int64()), ("target", pa.int64()), ("then", pa.int64()), ("then_first", pa.int64())])
_OPEN_DDL = "worker bigint, first bigint, target bigint, then bigint, then_first bigint"

Totals = dict[int, tuple[np.ndarray, int]]


class _Block:
    """Rows of consecutive ranges, and how many the worker had before them."""

    def __init__(self, first: int, rows: np.ndarray, base: int, batch_size: int):
        self.first, self.rows, self.batch_size = first, rows, batch_size
        self.after = base + np.cumsum(rows)
        self.before = np.append(self.after - rows, self.after[-1])
        # The batch that begins at each place ends before this place, beyond the last one if later.
        self.next = np.searchsorted(self.after, self.before + batch_size) + 1

    def enter(self, target: int) -> int:
        """Where the next batch begins after one that ends where ``target`` rows are reached."""
        return int(np.searchsorted(self.after, target)) + 1

    def leave(self) -> np.ndarray:
        """For each place, the last batch begun in the block on the way from there."""
        n = len(self.rows)
        last = np.where(self.next > n, np.arange(n + 1), self.next)
        last[n] = n
        while not np.array_equal(further := last[last], last):
            last = further
        return last

    def target(self, place: int) -> int:
        return int(self.before[place]) + self.batch_size


def pack_batches(
    counts: DataFrame,
    batch_size: int,
    workers: int = 1,
    partitions_per_worker: int | None = None,
    block_ranges: int = BLOCK_RANGES,
) -> DataFrame:
    """Pack whole ranges, in order, into batches of at least ``batch_size`` rows.

    ``counts`` has ``partition_index`` and ``rows_read`` for every range of a plan, empty
    ones too. The ranges are dealt to ``workers`` in equal consecutive runs (or in runs of
    ``partitions_per_worker``). A worker closes a batch when its pending rows reach the
    batch size; what is pending at the end is its left-over batch.
    Returns ``(worker, first_partition, last_partition, rows, leftover)``.
    """
    if batch_size < 1 or workers < 1 or (partitions_per_worker is not None and partitions_per_worker < 1):
        raise ValueError("batch_size, workers and partitions_per_worker must be positive")
    if partitions_per_worker is None:
        last = counts.agg(F.max(INDEX)).first()[0]
        partitions_per_worker = -(-((last or 0) + 1) // workers)
    return _pack_ranges(counts, batch_size, partitions_per_worker, block_ranges)


def _pack_ranges(counts: DataFrame, batch_size: int, per_worker: int, block_ranges: int) -> DataFrame:
    place = f"{INDEX} % {per_worker} div {block_ranges}"
    ranges = counts.selectExpr(f"{INDEX} div {per_worker} AS worker", f"{place} AS block", INDEX, "rows_read")
    listed = F.sort_array(F.collect_list(F.struct(INDEX, "rows_read")))
    blocks = set_aside(
        ranges.groupBy("worker", "block").agg(listed.alias("l"), F.sum("rows_read").alias("total"))
        .selectExpr("worker", "block", f"l[0].{INDEX} AS first", "l.rows_read AS rows", "total")
    )
    starts = blocks.where("block = 0").selectExpr("worker", "first", f"{batch_size}L AS target")
    totals = _totals(blocks)
    if totals:
        starts = starts.unionByName(_open_batches(blocks, starts, totals, batch_size))
    held = blocks.sparkSession.sparkContext.broadcast(totals)
    return _with_open(blocks, starts, held).mapInArrow(lambda b: _batches(b, held.value, batch_size), PACKED)


def _totals(blocks: DataFrame) -> Totals:
    """Per worker of several blocks: rows up to each block's end, and its last range."""
    several = blocks.where("block > 0").select("worker").distinct()
    found: dict[int, list] = {}
    wanted = blocks.join(several, "worker", "left_semi").selectExpr("worker", "block", "total", "first + size(rows) - 1 AS last")
    for row in wanted.collect():
        found.setdefault(row.worker, []).append((row.block, row.total, row.last))
    return {
        worker: (np.cumsum([total for _, total, _ in sorted(lines)]), max(last for _, _, last in lines))
        for worker, lines in found.items()
    }


def _base(totals: Totals, worker: int, block: int) -> int:
    return int(totals[worker][0][block - 1]) if block else 0


def _with_open(blocks: DataFrame, open_: DataFrame, held) -> DataFrame:
    """Blocks with the open batches that end in them; those of a worker that end nowhere are with its last block."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = []
            for worker, target in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                ends = held.value[worker][0] if worker in held.value else None
                at.append(0 if ends is None else min(int(np.searchsorted(ends, target)), len(ends) - 1))
            yield pa.record_batch([*batch.columns, pa.array(at, pa.int64())], names=["worker", "first", "target", "block"])

    placed = open_.select("worker", "first", "target").mapInArrow(place, "worker bigint, first bigint, target bigint, block bigint")
    listed = placed.groupBy("worker", "block").agg(F.collect_list(F.struct("first", "target")).alias("open"))
    return blocks.selectExpr("worker", "block", "first", "rows").join(listed, ["worker", "block"])


def _open_batches(blocks: DataFrame, starts: DataFrame, totals: Totals, batch_size: int) -> DataFrame:
    """``(worker, first, target)`` of the batches of workers of several blocks that are open at a block's end."""
    held = blocks.sparkSession.sparkContext.broadcast(totals)

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every batch a block may leave open."""
        for batch in batches:
            out = []
            for worker, number, first, rows in zip(*(c.to_pylist() for c in batch.columns)):
                if worker in held.value:
                    block = _Block(first, np.array(rows), _base(held.value, worker, number), batch_size)
                    out += [(worker, first + p, block.target(p), None, None) for p in np.unique(block.leave()).tolist()]
            yield _rows(out, _OPEN)

    def followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For every open batch that ends in a block, the one that the block leaves open then."""
        for batch in batches:
            out = []
            for worker, number, first, rows, open_ in zip(*(c.to_pylist() for c in batch.columns)):
                if worker not in held.value:
                    continue
                block = _Block(first, np.array(rows), _base(held.value, worker, number), batch_size)
                last = block.leave()
                for begun in open_:
                    at = block.enter(begun["target"])
                    if at <= len(rows):
                        then = int(last[at])
                        out.append((worker, begun["first"], begun["target"], block.target(then), first + then))
            yield _rows(out, _OPEN)

    several = starts.join(blocks.where("block = 1").select("worker"), "worker", "left_semi")
    may = blocks.select("worker", "block", "first", "rows").mapInArrow(left, _OPEN_DDL).select("worker", "first", "target")
    nodes = set_aside(may.unionByName(several).distinct())
    links = set_aside(_with_open(blocks, nodes, held).mapInArrow(followed, _OPEN_DDL))
    reached = several
    most = max(len(ends) for ends, _ in totals.values())
    for _ in range(most.bit_length()):
        ahead = reached.join(links, ["worker", "first", "target"]).selectExpr("worker", "then_first AS first", "then AS target")
        reached = set_aside(reached.unionByName(ahead).distinct())
        further = links.selectExpr("worker", "first AS then_first", "target AS then", "then AS t2", "then_first AS f2")
        links = set_aside(
            links.join(further, ["worker", "then_first", "then"])
            .selectExpr("worker", "first", "target", "t2 AS then", "f2 AS then_first")
        )
    return reached.join(several, ["worker", "first", "target"], "left_anti")


def _batches(batches: Iterator[pa.RecordBatch], totals: Totals, batch_size: int) -> Iterator[pa.RecordBatch]:
    """The batches that end in each block, and the one a worker has left."""
    for batch in batches:
        out = []
        for worker, number, first, rows, open_ in zip(*(c.to_pylist() for c in batch.columns)):
            alone = worker not in totals
            block = _Block(first, np.array(rows), 0 if alone else _base(totals, worker, number), batch_size)
            total, last = (int(block.after[-1]), first + len(rows) - 1) if alone else (int(totals[worker][0][-1]), totals[worker][1])
            for begun in open_:
                at, start, before = block.enter(begun["target"]), begun["first"], begun["target"] - batch_size
                if at > len(rows):  # no block ends it
                    if before < total:
                        out.append((worker, start, last, total - before, True))
                    continue
                while at <= len(rows):
                    upto = int(block.after[at - 1])
                    out.append((worker, start, first + at - 1, upto - before, False))
                    start, before = first + at, upto
                    at = int(block.next[at])
                if alone and before < total:
                    out.append((worker, start, last, total - before, True))
        yield _rows(out, _PACKED)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.record_batch([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)
