"""Near-duplicates by HyperMinHash: compressed registers, banded, then estimated, then verified.

The hashes of a document's shingles fall into buckets by their first bits. A bucket's
register holds its smallest hash as the number of leading zeros and the mantissa bits that
follow: 16 bits instead of 64, whatever the size of the set. Equal sets are one node.

1. Bands of registers are keys; nodes that share a key are a group. In a band, an empty
   register stands for a filled one of the same set, picked by a fixed random order, so that
   small sets agree in a register with the probability of their similarity, too.
2. Every node of a group is paired with the group's pivot, never with all others. Pairs whose
   estimate, corrected for registers that agree by chance, is six standard deviations below
   the threshold go; each node's best ones are verified on whole sets.
3. Groups that hold several components by then are compared register by register, in tiles of
   bounded size: nodes outside the largest component with all. Nodes with a likely partner are
   compared again in tiles, on whole sets. What a tile sends on is nodes, and a spanning
   forest of links, never pairs.

A link is missed if all bands differ, which at a similarity of 0.8 has a probability of some
10**-15, or by an estimate off by six standard deviations, some 10**-9.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangeloom.llm.common import (
    Words,
    bound_batches,
    discard,
    fold_table,
    mixed,
    texts_of,
    window_hashes,
    write_once,
)
from rangeloom.llm.regions import Tile, best_pivots, components_of_nodes, distinct_nodes, least_ids, set_key, sizes_allow

#: Words of a shingle.
SHINGLE = 2
#: Registers of a sketch (a power of two), registers of a band, mantissa bits of a register.
REGISTERS = 256
BAND = 4
MANTISSA = 10
EMPTY = np.uint16(0xFFFF)
_BITS = 53  # of a hash within its bucket
_SPREAD = 6.0

_FOLD = fold_table(lambda c: not (c == 0x20 or 0x09 <= c <= 0x0D), lower=True)
#: For each register the order in which filled ones stand for it when it is empty.
_STAND_IN = np.random.default_rng(12).random((REGISTERS, REGISTERS)).astype(np.float32)


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a short text is one shingle."""
    words = Words(texts, _FOLD)
    for k in range(len(texts)):
        own = words.hashes[words.of(k)]
        yield np.unique(window_hashes(own, min(size, len(own)))) if len(own) else own


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Registers of a sorted set of 64-bit hashes."""
    registers = np.full(REGISTERS, EMPTY)
    if not len(hashes):
        return registers
    shift = np.uint64(65 - REGISTERS.bit_length())
    bucket = (hashes >> shift).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    least = (hashes[first] & ((np.uint64(1) << shift) - np.uint64(1))) >> (shift - np.uint64(_BITS))
    zeros = _BITS - np.frexp(least.astype(np.float64))[1]
    after = (least << (zeros + 1).astype(np.uint64)) & np.uint64((1 << _BITS) - 1)
    registers[bucket[first]] = (zeros << MANTISSA) | (after >> np.uint64(_BITS - MANTISSA)).astype(np.int64)
    return registers


def filled(registers: np.ndarray) -> np.ndarray:
    """The registers with every empty one replaced by its stand-in."""
    empty = np.flatnonzero(registers == EMPTY)
    full = np.flatnonzero(registers != EMPTY)
    if not len(empty) or not len(full):
        return registers
    out = registers.copy()
    out[empty] = registers[full[_STAND_IN[np.ix_(empty, full)].argmin(axis=1)]]
    return out


def bands(registers: np.ndarray) -> np.ndarray:
    """The band keys of a sketch: 64 bits that are the band's registers, mixed with its number."""
    own = np.ascontiguousarray(filled(registers)).view(np.uint64)
    return mixed(own ^ mixed(np.arange(1, len(own) + 1, dtype=np.uint64)))


def chance_matches() -> np.ndarray:
    """Registers expected to agree by chance for two unrelated sets of ``2**k`` elements, by ``k``."""
    cells = 1 << MANTISSA
    zeros = np.arange(_BITS)[:, None]
    edges = np.ldexp(1 + np.arange(cells + 1) / cells, -(zeros + 1))  # of each zero count, as shares of a bucket
    out = []
    for k in range(40):
        above = np.exp(2.0**k * np.log1p(-edges / REGISTERS))
        out.append(REGISTERS * ((above[:, :-1] - above[:, 1:]) ** 2).sum())
    return np.array(out)


def estimate(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, chance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Similarity of pairs of sketches (rows of ``a`` and ``b``), and the standard deviation at 0.8."""
    used = ((a != EMPTY) | (b != EMPTY)).sum(axis=1)
    agree = ((a == b) & (a != EMPTY)).sum(axis=1)
    level = np.log2(np.maximum(sizes, 1))
    by_chance = np.interp(level, np.arange(len(chance)), chance)
    by_chance = np.minimum(by_chance, used / 2)  # tiny sets
    return (agree - by_chance) / (used - by_chance), np.sqrt(0.16 / np.maximum(used, 1))


def _likely(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, chance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, deviation = estimate(a, b, np.sqrt(n.astype(np.float64) * m), chance)
    return found, found >= 0.8 - _SPREAD * deviation


def _sketches(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.uint16).reshape(-1, REGISTERS)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, keys, sketches = [], [], []
        for hashes in shingle_sets(texts_of(batch.column(1))):
            sizes.append(len(hashes))
            keys.append(set_key(hashes))
            sketches.append(sketch(hashes).tobytes())
        yield pa.record_batch(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.string()), pa.array(sketches, pa.binary())],
            names=["doc_id", "n", "set_key", "sketch"],
        )


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count = REGISTERS // BAND
    for batch in batches:
        keys = [bands(own) for own in _sketches(batch.column(2))] if batch.num_rows else []
        yield pa.record_batch(
            [
                np.concatenate([np.empty(0, np.uint64), *keys]).view(np.int64),
                np.tile(np.arange(count, dtype=np.int32), batch.num_rows),
                np.repeat(batch.column(0).to_numpy(), count),
                np.repeat(batch.column(1).to_numpy(), count),
            ],
            names=["key", "band", "node", "n"],
        )


def _members(nodes: DataFrame) -> DataFrame:
    """``key, band, node, n, members, pivot, pivot_n`` of the groups of two nodes or more."""
    # A set of three shingles links with equal ones only.
    rows = nodes.where("n > 3").select("node", "n", "sketch").mapInArrow(
        _band_rows, "key bigint, band int, node bigint, n bigint"
    )
    pivot = F.min(F.struct(F.xxhash64("node").alias("h"), "node", "n"))
    groups = rows.groupBy("key").agg(F.count("*").alias("members"), pivot.alias("p")).where("members > 1")
    groups = groups.select("key", "members", F.col("p.node").alias("pivot"), F.col("p.n").alias("pivot_n"))
    return write_once(rows.join(groups, "key"), large=True)


def _pivot_pairs(members: DataFrame, nodes: DataFrame, chance: np.ndarray) -> DataFrame:
    """``a, b``: nodes ``b`` with the likeliest pivots ``a`` of their groups, as far as likely to link at all."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            found, likely = _likely(_sketches(batch.column(4)), _sketches(batch.column(5)), n, m, chance)
            yield pa.record_batch(
                [batch.column(0).filter(pa.array(likely)), batch.column(1).filter(pa.array(likely)), found[likely]],
                names=["a", "b", "likeness"],
            )

    pairs = (
        members.where("node <> pivot").where(sizes_allow(F.col("n"), F.col("pivot_n")))
        .select(F.col("pivot").alias("a"), F.col("node").alias("b"), F.col("pivot_n").alias("n"), F.col("n").alias("m")).distinct()
    )
    one, other = (nodes.select(F.col("node").alias(i), F.col("sketch").alias(f"sketch_{i}")) for i in "ab")
    both = pairs.join(one, "a").join(other, "b").select("a", "b", "n", "m", "sketch_a", "sketch_b")
    judged = both.mapInArrow(judge, "a bigint, b bigint, likeness double")
    return write_once(best_pivots(judged, "likeness"), large=True)


def _likely_in_tile(chance: np.ndarray) -> Callable[[Tile, pa.Table], np.ndarray]:
    """Marks nodes of a tile with a partner that is likely to link, by the estimate."""

    def marked(tile: Tile, table: pa.Table) -> np.ndarray:
        raw = _sketches(table.column("sketch"))
        found = np.zeros(len(raw), bool)
        for i in tile.left:
            j = tile.right[tile.partners(i)]
            if len(j):
                _, likely = _likely(raw[j], raw[i], tile.n[j], np.full(len(j), tile.n[i]), chance)
                found[j[likely]] = True
                found[i] |= likely.any()
        return found

    return marked


def _components(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, component`` of the nodes that link."""
    chance = chance_matches()
    members = _members(nodes)
    pairs = _pivot_pairs(members, nodes, chance)
    hubs = members.select(F.col("pivot").alias("hub"), "node", "n").distinct()
    found = components_of_nodes(
        docs, nodes, hubs, pairs, nodes.select("node", "sketch"), _likely_in_tile(chance), shingle_sets
    )
    discard(members, pairs)
    return found


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Reads ``doc_id, text``. Words are runs of anything but space and U+0009 to U+000D, with
    ASCII capitals as small letters; a set is the distinct runs of :data:`SHINGLE` words, or
    the one run of all words of a shorter text. Two documents link if their sets share 80%
    of their union. ``component_id`` is the smallest doc_id reachable by links; ``kept`` says
    that it is the document's own.

    Texts without words (null, empty) have an empty set and link with nothing. A null doc_id
    links with nothing either; its component and ``kept`` are null. Repeated rows link, and
    so do equal sets under one doc_id; different texts under one doc_id are judged each by
    itself. An empty table gives no rows. Other columns of ``docs`` are left out.
    """
    bound_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    sets = write_once(docs.mapInArrow(_sets, "doc_id bigint, n bigint, set_key string, sketch binary"))
    nodes = distinct_nodes(sets, "n", "sketch")
    found = least_ids(sets, nodes, _components(docs.where("doc_id IS NOT NULL"), nodes))
    return found.withColumnRenamed("n", "n_shingles").withColumn("kept", F.col("doc_id") == F.col("component_id"))
