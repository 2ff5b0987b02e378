"""Links of nodes (distinct sets of shingles) that share a hub: verified on whole sets.

A hub is a pivot node with all nodes that some evidence brings together with it. The best
pivots of each node are verified first. Hubs that hold several components by then are
compared in tiles of bounded size, the nodes outside a hub's largest component with all: once
by the evidence, which gives nodes with a possible partner, once more on the whole sets of
those. What a tile sends on is nodes, and a spanning forest of links, never pairs, so a hub of
many texts that are alike costs rows in proportion to its nodes and the number of its blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from rangeloom.llm.common import connected_components, discard, texts_of, write_once

#: Pivots a node is verified against before all the others are looked at.
PIVOTS = 4
#: Nodes of a block of a hub, and shingles of all their sets.
BLOCK = 1_024
BLOCK_SHINGLES = 1_000_000
#: Shingles that sets are compared on at a time.
COLUMNS = 4_096
#: Pairs of one text that are verified by one task in one go.
RUN = 256

Sets = Callable[[list[bytes]], Iterator[np.ndarray]]
Likely = Callable[["Tile", pa.Table], np.ndarray]


def set_key(hashes: np.ndarray) -> str:
    return xxhash.xxh3_128_hexdigest(hashes.tobytes())


def sizes_allow(n: Column, m: Column) -> Column:
    return 5 * F.least(n, m) >= 4 * F.greatest(n, m)


def best_pivots(pairs: DataFrame, weight: str) -> DataFrame:
    """``a, b``: each node ``b`` with its :data:`PIVOTS` best pivots ``a``."""
    place = F.row_number().over(Window.partitionBy("b").orderBy(F.col(weight).desc(), "a"))
    return pairs.withColumn("__place", place).where(F.col("__place") <= PIVOTS).select("a", "b")


def _verify_runs(batches: Iterator[pa.RecordBatch], shingle_sets: Sets) -> Iterator[pa.RecordBatch]:
    """Sets of a run's first text and of the others, compared as they stream by."""
    run, first = None, None
    for batch in batches:
        a, salt, role, node, keys = (batch.column(i).to_pylist() for i in range(5))
        pairs = []
        for k, hashes in enumerate(shingle_sets(texts_of(batch.column(5)))):
            if set_key(hashes) != keys[k]:
                continue  # another text under the same doc_id
            if role[k] == 0:
                run, first = (a[k], salt[k]), hashes
            elif run == (a[k], salt[k]):
                shared = len(np.intersect1d(first, hashes, assume_unique=True))
                if 100 * shared >= 80 * (len(first) + len(hashes) - shared):
                    pairs.append((a[k], node[k]))
        yield pa.record_batch([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])


def _verified(pairs: DataFrame, texts: DataFrame, shingle_sets: Sets) -> DataFrame:
    """The links among ``pairs``: similarity of whole sets, a text once per :data:`RUN` pairs."""
    runs = F.ceil(F.count("*").over(Window.partitionBy("a")) / F.lit(RUN))
    dealt = pairs.select("a", "b").withColumn("runs", runs).withColumn("salt", F.pmod(F.xxhash64("b"), "runs"))
    want = dealt.select("a", "salt", F.lit(1).alias("role"), F.col("b").alias("node")).unionByName(
        dealt.select("a", "salt", F.lit(0).alias("role"), F.col("a").alias("node")).distinct()
    )
    rows = want.join(texts, "node").select("a", "salt", "role", "node", "set_key", "text")
    lined = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", "role")
    return write_once(lined.mapInArrow(lambda b: _verify_runs(b, shingle_sets), "a bigint, b bigint"), large=True)


def placed_in(rows: DataFrame, components: DataFrame, column: str, name: str) -> DataFrame:
    found = components.select(F.col("node").alias(column), F.col("component").alias("__found"))
    return rows.join(found, column, "left").withColumn(name, F.coalesce("__found", column)).drop("__found")


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each tile, which come one after the other."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        mark = np.stack([batch.column(c).to_numpy() for c in ("hub", "t1", "t2")])
        cuts = [0, *(np.flatnonzero((mark[:, 1:] != mark[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            if last is not None and tuple(mark[:, a]) != last:
                yield pa.Table.from_batches(held)
                held.clear()
            last = tuple(mark[:, a])
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


class Tile:
    """Nodes of a block outside a hub's largest component, and a block of all of its nodes."""

    def __init__(self, table: pa.Table):
        self.hub = table.column("hub")[0].as_py()
        self.node, self.n, self.component = (table.column(c).to_numpy() for c in ("node", "n", "component"))
        side = table.column("left").to_numpy()
        self.left, self.right = np.flatnonzero(side), np.flatnonzero(~side)

    def partners(self, i: int) -> np.ndarray:
        """Places in ``right`` of another component and a size that allows a link."""
        n, m = self.n[self.right], self.n[i]
        fit = (self.component[self.right] != self.component[i]) & (5 * np.minimum(n, m) >= 4 * np.maximum(n, m))
        return np.flatnonzero(fit)


def _likely_nodes(batches: Iterator[pa.RecordBatch], likely: Likely) -> Iterator[pa.RecordBatch]:
    """Nodes of a tile with a partner that may link."""
    for table in _tiles(batches):
        tile = Tile(table)
        nodes = np.unique(tile.node[likely(tile, table)])
        yield pa.record_batch([np.full(len(nodes), tile.hub), nodes], names=["hub", "node"])


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets on the left with all on the right."""
    sets = [*left, *right]
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, several = np.unique(np.concatenate([np.empty(0, np.uint64), *sets]), return_inverse=True, return_counts=True)
    kept = several[column] > 1
    row, column = row[kept], np.unique(column[kept], return_inverse=True)[1]
    out = np.zeros((len(left), len(right)), np.float32)  # exact below 2**24
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        part = slice(*np.searchsorted(column, [a, a + COLUMNS]))
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[row[part], column[part] - a] = 1
        out += held[: len(left)] @ held[len(left) :].T
    return out


def _tile_links(batches: Iterator[pa.RecordBatch], shingle_sets: Sets) -> Iterator[pa.RecordBatch]:
    """The links of a tile between components, as a spanning forest of them."""
    for table in _tiles(batches):
        sets = list(shingle_sets(texts_of(table.column("text"))))
        keys = table.column("set_key").to_pylist()
        own = [k for k, s in enumerate(sets) if set_key(s) == keys[k]]
        pairs = []
        if own:
            tile, sets = Tile(table.take(pa.array(own, pa.int64()))), [sets[k] for k in own]
            shared = shared_counts([sets[k] for k in tile.left], [sets[k] for k in tile.right])
            parent = {c: c for c in tile.component.tolist()}
            for at, i in enumerate(tile.left):
                places = tile.partners(i)
                both, j = shared[at, places].astype(np.int64), tile.right[places]
                for k in j[100 * both >= 80 * (tile.n[i] + tile.n[j] - both)].tolist():
                    a, b = _top(parent, int(tile.component[i])), _top(parent, int(tile.component[k]))
                    if a != b:
                        parent[a] = b
                        pairs.append((int(tile.node[i]), int(tile.node[k])))
        yield pa.record_batch([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _top(parent: dict[int, int], x: int) -> int:
    while parent[x] != x:
        parent[x] = x = parent[parent[x]]
    return x


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows of hubs of several components, for tiles ``t1, t2``.

    Nodes of the largest component need no comparison with each other: a tile is a block
    of the other nodes, on the ``left``, with a block of all nodes.
    """
    per = rows.groupBy("hub", "component").agg(F.count("*").alias("m"), F.sum("n").alias("s"))
    sizes = per.groupBy("hub").agg(
        F.max(F.struct("m", "component", "s")).alias("top"), F.sum("m").alias("m"), F.sum("s").alias("s"), F.count("*").alias("parts")
    ).where("parts > 1")
    blocks = lambda m, s: F.greatest(F.ceil(m / F.lit(BLOCK)), F.ceil(s / F.lit(BLOCK_SHINGLES)), F.lit(1)).cast("int")
    sizes = sizes.select(
        "hub", F.col("top.component").alias("major"), blocks(F.col("m"), F.col("s")).alias("blocks"),
        blocks(F.col("m") - F.col("top.m"), F.col("s") - F.col("top.s")).alias("others"),
    )
    placed = rows.join(sizes, "hub")
    every = F.explode(F.sequence(F.lit(0), F.col("others") - 1))
    right = placed.select("hub", every.alias("t1"), F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("t2"), F.lit(False).alias("left"), "node", "n", "component")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = placed.where("component <> major").select(
        "hub", F.pmod(F.xxhash64("node", F.lit(1)), "others").cast("int").alias("t1"), every.alias("t2"), F.lit(True).alias("left"), "node", "n", "component"
    )
    return left.unionByName(right)


def _lined(tiles: DataFrame) -> DataFrame:
    return tiles.repartition("hub", "t1", "t2").sortWithinPartitions("hub", "t1", "t2")


def _open_links(hubs: DataFrame, evidence: DataFrame, texts: DataFrame, likely: Likely, shingle_sets: Sets) -> DataFrame:
    """Links that join the components within a hub, as forests; ``hubs`` has ``hub, node, n, component``."""
    tiles = _lined(_dealt(hubs).join(evidence, "node"))
    nodes = tiles.mapInArrow(lambda b: _likely_nodes(b, likely), "hub bigint, node bigint")
    rest = write_once(hubs.join(nodes.distinct(), ["hub", "node"], "left_semi"), large=True)
    tiles = _lined(_dealt(rest).join(texts, "node"))
    found = write_once(tiles.mapInArrow(lambda b: _tile_links(b, shingle_sets), "a bigint, b bigint"), large=True)
    discard(rest)
    return found


def components_of_nodes(
    docs: DataFrame,
    nodes: DataFrame,
    members: DataFrame,
    pairs: DataFrame,
    evidence: DataFrame,
    likely: Likely,
    shingle_sets: Sets,
) -> DataFrame:
    """``node, component`` of the nodes that link.

    ``nodes`` has ``node, x, set_key`` (``x`` a doc_id of the set), ``members`` all distinct
    ``hub, node, n``, the hub's own among them, ``pairs`` the pivots ``a`` that nodes ``b`` are
    verified against first, ``evidence`` a column per node for ``likely``.
    """
    grouped = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "x", "set_key")
    texts = write_once(docs.join(grouped, docs.doc_id == grouped.x).select("node", "set_key", "text"), large=True)
    links = _verified(pairs, texts, shingle_sets)
    components = connected_components(links)
    hubs = write_once(placed_in(members, components, "node", "component"), large=True)
    more = _open_links(hubs, evidence, texts, likely, shingle_sets)
    if not more.isEmpty():
        components = connected_components(links.unionByName(more))
    discard(texts, hubs)
    return components


def least_ids(sets: DataFrame, nodes: DataFrame, components: DataFrame) -> DataFrame:
    """``doc_id, n, component_id`` of all rows of ``sets`` (``doc_id, n, set_key``): the smallest id reached.

    A row without words or id is alone.
    """
    placed = placed_in(nodes.select("node", "set_key", "x"), components, "node", "component")
    least = placed.groupBy("component").agg(F.min("x").alias("component_id"))
    found = placed.join(least, "component").select("set_key", "component_id")
    some = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key")
    return sets.select("doc_id", "n", some).join(found, "set_key", "left").select(
        "doc_id", "n", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def distinct_nodes(sets: DataFrame, *columns: str) -> DataFrame:
    """``set_key, x, node`` and ``columns`` of each distinct set; numbered and written once."""
    first = [F.first(c).alias(c) for c in columns]
    return write_once(
        sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("set_key").agg(F.min("doc_id").alias("x"), *first)
        .withColumn("node", F.monotonically_increasing_id()),
        large=True,
    )
