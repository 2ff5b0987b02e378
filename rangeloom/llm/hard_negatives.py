"""Hard negatives by exact inner products: Strassen products of integer tiles, heaps of the best.

Vectors become integers first, so that scores are exact and ties are ties. A block of
anchors, bounded in bytes, goes to all tasks; each multiplies it with its candidates tile
by tile. One pass keeps every anchor's best rows of its own label (the positives), the
next, with the positives' windows known, the best rows of other labels in each window.

A heap is the best few entries of an anchor (or of an anchor's window) so far. A task's
heaps hold what its rows gave, and heaps are merged by keeping the best few of all their
entries; a task sends at most a heap per anchor, however many rows it read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rangeloom.llm.common import bound_batches, discard, shared, trim, write_once

#: Side of a product small enough for the plain one.
LEAF = 16
#: Anchors and candidates of a tile.
TILE = (256, 2048)
#: Bytes of a block of anchors, as integers, that is sent to every task.
BLOCK_BYTES = 16 << 20
#: Rows of a part of the candidates; there are as many parts as the session has cores, at least.
PART_ROWS = 500_000

_HEAP = "anchor bigint, row bigint, vec_id bigint, score bigint"


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of int64 matrices by seven products of quarters instead of eight.

    Odd sides are padded with zeros. Sums wrap modulo 2**64, so a result that fits 64
    bits is exact whatever passed through on the way.
    """
    m, k, n = *a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a, b = np.pad(a, ((0, m % 2), (0, k % 2))), np.pad(b, ((0, k % 2), (0, n % 2)))
        return strassen(a, b, leaf)[:m, :n]
    top, left = slice(0, m // 2), slice(0, k // 2)
    low, right = slice(m // 2, m), slice(k // 2, k)
    first, second = slice(0, n // 2), slice(n // 2, n)
    a11, a12, a21, a22 = a[top, left], a[top, right], a[low, left], a[low, right]
    b11, b12, b21, b22 = b[left, first], b[left, second], b[right, first], b[right, second]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    out = np.empty((m, n), np.int64)
    out[top, second] = p3 + p5
    out[low, first] = p2 + p4
    out[top, first] = p1 + p4 - p5 + strassen(a12 - a22, b21 + b22, leaf)
    out[low, second] = p1 - p2 + p3 + strassen(a21 - a11, b11 + b12, leaf)
    return out


class Heaps:
    """The best ``size`` entries of each of ``n`` groups: higher score first, then smaller id, then row."""

    def __init__(self, n: int, size: int):
        self.size = size
        self.filled = np.zeros(n, np.int64)
        self.scores = np.zeros((n, size), np.int64)
        self.ids = np.zeros((n, size), np.int64)
        self.rows = np.zeros((n, size), np.int64)
        self.least = np.full(n, np.iinfo(np.int64).min)  # a lower score cannot get in

    def push(self, group: np.ndarray, score: np.ndarray, vec_id: np.ndarray, row: np.ndarray) -> None:
        if not len(group):
            return
        touched = np.unique(group)
        held = np.repeat(touched, self.filled[touched])
        at = np.arange(len(held)) - np.repeat(
            np.cumsum(self.filled[touched]) - self.filled[touched], self.filled[touched]
        )
        group = np.concatenate([held, group])
        score = np.concatenate([self.scores[held, at], score])
        vec_id = np.concatenate([self.ids[held, at], vec_id])
        row = np.concatenate([self.rows[held, at], row])
        order = np.lexsort((row, vec_id, -score, group))
        group, score, vec_id, row = group[order], score[order], vec_id[order], row[order]
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        sizes = np.diff(np.append(first, len(group)))
        place = np.arange(len(group)) - np.repeat(first, sizes)
        best = place < self.size
        group, place = group[best], place[best]
        self.scores[group, place], self.ids[group, place], self.rows[group, place] = score[best], vec_id[best], row[best]
        self.filled[touched] = np.minimum(sizes, self.size)
        full = touched[self.filled[touched] == self.size]
        self.least[full] = self.scores[full, -1]

    def entries(self) -> tuple[np.ndarray, ...]:
        """Group, row, id and score of all entries."""
        group = np.repeat(np.arange(len(self.filled)), self.filled)
        at = np.arange(len(group)) - np.repeat(np.cumsum(self.filled) - self.filled, self.filled)
        return group, self.rows[group, at], self.ids[group, at], self.scores[group, at]


class Block:
    """Some rows as arrays: where they are, whose they are, and their vectors padded to one width."""

    def __init__(self, batch: pa.RecordBatch | pa.Table):
        table = pa.table(batch)
        self.row, self.vec_id, self.label = (
            table.column(name).to_numpy().astype(np.int64) for name in ("row", "vec_id", "label")
        )
        vectors = table.column("vector").combine_chunks()
        sizes = vectors.value_lengths().to_numpy().astype(np.int64)
        self.vectors = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
        at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.vectors[np.repeat(np.arange(len(sizes)), sizes), at] = vectors.flatten().to_numpy()

    def part(self, chosen) -> "Block":
        own = object.__new__(Block)
        own.row, own.vec_id, own.label = self.row[chosen], self.vec_id[chosen], self.label[chosen]
        own.vectors = self.vectors[chosen]
        return own


def _tiles(anchors: Block, places: np.ndarray, others: Block) -> Iterator[tuple[np.ndarray, Block, np.ndarray]]:
    """Scores of the anchors at ``places`` with the others: places, candidates, product."""
    wide = max(anchors.vectors.shape[1], others.vectors.shape[1], 1)
    pad = lambda m: np.pad(m, ((0, 0), (0, wide - m.shape[1])))
    for c in range(0, len(others.row), TILE[1]):
        some = others.part(slice(c, c + TILE[1]))
        right = np.ascontiguousarray(pad(some.vectors).T)
        for a in range(0, len(places), TILE[0]):
            own = places[a : a + TILE[0]]
            yield own, some, strassen(pad(anchors.vectors[own]), right)


def _sent(anchors: Block, heaps: Heaps, per_anchor: int) -> pa.RecordBatch:
    """Heaps as rows; an entry in several windows of an anchor is sent once."""
    group, row, vec_id, score = heaps.entries()
    anchor = anchors.row[group // per_anchor]
    if per_anchor > 1:
        _, once = np.unique(np.stack([group // per_anchor, row]), axis=1, return_index=True)
        anchor, row, vec_id, score = anchor[once], row[once], vec_id[once], score[once]
    return pa.record_batch([anchor, row, vec_id, score], names=["anchor", "row", "vec_id", "score"])


def _best_of_label(batches: Iterator[pa.RecordBatch], anchors: Block, size: int) -> Iterator[pa.RecordBatch]:
    heaps = Heaps(len(anchors.row), size)
    by_label = np.argsort(anchors.label, kind="stable")
    labels = anchors.label[by_label]
    for batch in batches:
        trim()
        block = Block(batch)
        block = block.part(np.argsort(block.label, kind="stable"))
        for label in np.intersect1d(block.label, labels):
            own = by_label[slice(*np.searchsorted(labels, [label, label + 1]))]
            same = block.part(slice(*np.searchsorted(block.label, [label, label + 1])))
            for places, some, scores in _tiles(anchors, own, same):
                i, j = np.nonzero(scores >= heaps.least[places][:, None])
                other = some.row[j] != anchors.row[places[i]]
                i, j = i[other], j[other]
                heaps.push(places[i], scores[i, j], some.vec_id[j], some.row[j])
    yield _sent(anchors, heaps, 1)


def _best_in_windows(
    batches: Iterator[pa.RecordBatch], anchors: Block, low: np.ndarray, high: np.ndarray, size: int
) -> Iterator[pa.RecordBatch]:
    """Best rows of other labels with ``low <= score <= high``, both ``[anchor, window]``."""
    n, windows = low.shape
    heaps = Heaps(n * windows, size)
    busy = np.flatnonzero((low <= high).any(axis=1))
    ceiling = np.where(low <= high, high, np.iinfo(np.int64).min).max(axis=1)
    for batch in batches:
        trim()
        for places, some, scores in _tiles(anchors, busy, Block(batch)):
            least = np.maximum(low, heaps.least.reshape(n, windows))[places]
            floor = np.where((low <= high)[places], least, np.iinfo(np.int64).max).min(axis=1)
            i, j = np.nonzero((scores >= floor[:, None]) & (scores <= ceiling[places][:, None]))
            other = some.label[j] != anchors.label[places[i]]
            i, j = i[other], j[other]
            score = scores[i, j]
            for w in range(windows):
                fit = (score >= least[i, w]) & (score <= high[places[i], w])
                group = places[i[fit]] * windows + w
                heaps.push(group, score[fit], some.vec_id[j[fit]], some.row[j[fit]])
    yield _sent(anchors, heaps, windows)


def integer_rows(vectors: DataFrame, anchors: Column, scale: int) -> DataFrame:
    """``row, vec_id, label, vector, anchor`` of the rows that take part, numbered and written once."""
    component = lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))
    finite = lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False))
    whole = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding",
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(F.forall("embedding", finite))
    # Scores must fit 64 bits, with room for the percentages of the windows.
    largest = F.lit(2.0**26) / F.sqrt(F.greatest(F.size("embedding"), F.lit(1)).cast("double"))
    fits = F.forall("embedding", lambda x: F.abs(F.lit(float(scale)) * x.cast("double")) < largest)
    vector = F.when(fits, F.transform("embedding", component)).otherwise(
        F.raise_error(F.concat(F.lit("components too large for exact scores: vec_id "), F.col("vec_id").cast("string")))
    )
    spark = vectors.sparkSession
    chosen = whole.select("vec_id", "label", vector.alias("vector"), "anchor")
    n = vectors.count()
    parts = max(spark.sparkContext.defaultParallelism, -(-n // PART_ROWS))
    return write_once(chosen.repartition(parts).withColumn("row", F.monotonically_increasing_id()))


def _anchor_blocks(rows: DataFrame) -> Iterator[Block]:
    """The anchors in blocks of bounded size."""
    own = rows.where("anchor")
    n, wide = own.agg(F.count("*"), F.max(F.size("vector"))).first()
    if not n:
        return
    blocks = -(-n * 8 * max(wide, 1) // BLOCK_BYTES)
    dealt = write_once(
        own.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
        .repartition(blocks, "block").select("block", "row", "vec_id", "label", "vector")
    )
    for block in range(blocks):
        yield Block(dealt.where(F.col("block") == block).drop("block").toArrow())
    discard(dealt)


def mine(
    vectors: DataFrame,
    anchors: Column,
    *,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
) -> DataFrame:
    """Hard negatives: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Reads ``vec_id, label, embedding``; ``anchors`` is a condition on the columns of
    ``vectors``. A component x becomes ``floor(scale * x)``, a score is an inner product of
    those. An anchor's positives are its best ``positives`` other rows of its label. For
    each there follow the best ``negatives`` rows of other labels whose score is ``low`` to
    ``high`` percent of the positive's. Higher scores are better, then smaller vec_ids.

    Rows with a null vec_id, label, vector or component, or one that is not finite, take no
    part. Every row counts by itself: a copy of the anchor is another row, and rows that
    share a vec_id are each an anchor or a candidate. A shorter vector ends in zeros. An
    anchor without positives, or a positive with an empty window (always so below a score
    of 0), gives no rows; an empty table gives none. Components so large that a score could
    leave 64 bits are an error. All other columns of ``vectors`` are left out.
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    rows = integer_rows(vectors, anchors, scale)
    best = lambda *by: Window.partitionBy(*by).orderBy(F.col("score").desc(), "vec_id", "row")
    none = spark.createDataFrame(
        [], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    )
    candidates = rows.select("row", "vec_id", "label", "vector")
    found = []
    for block in _anchor_blocks(rows):
        sent = shared(spark, block)
        partly = candidates.mapInArrow(lambda b, s=sent: _best_of_label(b, s(), positives), _HEAP)
        firsts = write_once(
            partly.withColumn("place", F.row_number().over(best("anchor"))).where(F.col("place") <= positives)
        )
        # At most ``positives`` rows for each anchor of the block.
        known = firsts.toArrow()
        order = np.argsort(block.row)
        at = order[np.searchsorted(block.row, known.column("anchor").to_numpy(), sorter=order)]
        window, score = known.column("place").to_numpy() - 1, known.column("score").to_numpy()
        lows, highs = np.ones((len(block.row), positives), np.int64), np.zeros((len(block.row), positives), np.int64)
        lows[at, window], highs[at, window] = -(-low * score // 100), high * score // 100
        windows = shared(spark, (lows, highs))
        partly = candidates.mapInArrow(
            lambda b, s=sent, w=windows: _best_in_windows(b, s(), *w(), negatives), _HEAP
        )
        p, e = firsts.alias("p"), partly.alias("e")
        inside = (
            (F.col("p.anchor") == F.col("e.anchor"))
            & (low * F.col("p.score") <= 100 * F.col("e.score")) & (100 * F.col("e.score") <= high * F.col("p.score"))
        )
        names = spark.createDataFrame(
            pa.table({"anchor": block.row, "anchor_id": block.vec_id})
        )
        ranked = (
            e.join(p, inside)
            .select("p.anchor", F.col("p.row").alias("positive"), F.col("p.vec_id").alias("positive_id"),
                    F.col("p.score").alias("positive_score"), "e.row", "e.vec_id", "e.score")
            .withColumn("rank", F.row_number().over(best("anchor", "positive")))
            .where(F.col("rank") <= negatives)
            .join(names, "anchor")
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score"))
        )
        found.append(write_once(ranked))
        discard(firsts)
    discard(rows)
    if not found:
        return none
    return spark.read.schema(none.schema).parquet(*[part.step_path for part in found])
