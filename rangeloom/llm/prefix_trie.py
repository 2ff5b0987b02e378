"""The trie of conversations' turns, by burst containers that are sorted and swept.

A conversation is the sequence of its turns' ids, 16 bytes each, in one binary value whose
byte order is the order of the sequences. Equal sequences are one entry with a count.

* All entries start as suffixes in the container of the root. A container with too many
  bursts: what its suffixes share becomes a chain of nodes, and by the next turn id they go,
  without it, to containers under new heads. Rounds end when no container is too large;
  each round is one pass over the entries that still move.
* The other containers are dealt out to tasks by their heads, sorted, and swept into nodes:
  a stack holds the nodes from the head to the current suffix, and closes a node when a
  suffix comes that is not below it.
* Burst heads are few; their sums are those of the containers below them, last round first.

A task holds the open nodes and their children within one container, at most. A conversation
is one row of 16 bytes for the id and 8 for the words of each turn; its texts never are.
"""

from __future__ import annotations

import hashlib
import os.path
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rangeloom.llm.common import bound_batches, discard, write_once
from rangeloom.llm.mixing import word_count

#: Entries of a container beyond which it bursts.
CONTAINER = 20_000
#: Bytes of a turn id, and of a turn's number of words.
TURN, WORDS = 16, 8

NOTHING = hashlib.sha256().hexdigest()

_SUMS = "conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
_NODE = f"top boolean, head binary, parent binary, depth bigint, parent_conv_id bigint, {_SUMS}"
_ENTRY = "seq binary, words binary, n bigint, conv_id bigint, ends string"


def _pack_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of turns of one conversation as pieces, in the order they come in."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    for at, batch in enumerate(batches):
        if not batch.num_rows:
            continue
        conv = batch.column(0).to_numpy()
        ids, words = b"".join(batch.column(1).to_pylist()), batch.column(2).to_numpy().astype("<i8").tobytes()
        cuts = [0, *(np.flatnonzero(conv[1:] != conv[:-1]) + 1).tolist(), len(conv)]
        spans = list(zip(cuts[:-1], cuts[1:], strict=True))
        yield pa.record_batch(
            [
                conv[cuts[:-1]], np.full(len(spans), part), np.full(len(spans), at),
                pa.array([ids[TURN * a : TURN * b] for a, b in spans], pa.binary()),
                pa.array([words[WORDS * a : WORDS * b] for a, b in spans], pa.binary()),
            ],
            names=["conv_id", "part", "at", "seq", "words"],
        )


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, seq, words``: each conversation's turn ids and their numbers of words, as binaries.

    Turns come by ``turn`` (null first), those of one number by their id, a hash of role and
    text (null: empty). A conversation is cut where tasks of a global sort end and put
    together again as pieces, so that a very long one is sorted by several tasks. Rows
    without a conv_id are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))).alias("id"),
        word_count(text).alias("words"),
    )
    lined = turns.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "id")
    pieces = lined.select("conv_id", "id", "words").mapInArrow(
        _pack_turns, "conv_id bigint, part bigint, at bigint, seq binary, words binary"
    )
    whole = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "at", "seq", "words"))).alias("p"))
    joined = lambda name: F.when(F.size("p") == 1, F.col("p")[0][name]).otherwise(
        F.aggregate("p", F.lit(b""), lambda done, piece: F.concat(done, piece[name]))
    )
    return whole.select("conv_id", joined("seq").alias("seq"), joined("words").alias("words"))


def with_first_turns(sequences: DataFrame, of: Column, n: Column, most: int) -> DataFrame:
    """Every sequence with its first ``n`` turns (at most ``most``) in exchange for those of another one.

    ``of`` is the other's conv_id; there are fewer turns if it has fewer, none if there is
    no such sequence. Only the first ``most`` turns of the others are moved.
    """
    n = F.least(n.cast("int"), F.lit(most))
    wanted = sequences.select("*", of.alias("__of"), n.alias("__n"))
    firsts = sequences.select(
        F.col("conv_id").alias("__of"), _slice("seq", F.lit(0), F.lit(most), TURN).alias("__seq"),
        _slice("words", F.lit(0), F.lit(most), WORDS).alias("__words"),
    ).join(wanted.select("__of").distinct(), "__of", "left_semi")
    both = wanted.join(firsts, "__of", "left")

    def exchanged(name: str, width: int) -> Column:
        taken = F.coalesce(_slice(f"__{name}", F.lit(0), F.col("__n"), width), F.lit(b""))
        return F.concat(taken, _slice(name, F.col("__n"), None, width)).alias(name)

    return both.select("conv_id", exchanged("seq", TURN), exchanged("words", WORDS))


def _slice(name: str, skip: Column, take: Column | None, width: int) -> Column:
    length = F.octet_length(name) if take is None else take * width
    return F.substring(F.col(name), skip * width + 1, length)


def _pack_equal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal sequences: one row, with their conv_ids as text."""
    for batch in batches:
        seq, conv = batch.column(1).to_pylist(), batch.column(0).to_pylist()
        cuts = [k for k in range(len(seq)) if k == 0 or seq[k] != seq[k - 1]]
        spans = list(zip(cuts, [*cuts[1:], len(seq)], strict=True))
        yield pa.record_batch(
            [
                batch.column(1).take(pa.array(cuts, pa.int64())), batch.column(2).take(pa.array(cuts, pa.int64())),
                pa.array([b - a for a, b in spans], pa.int64()), pa.array([conv[a] for a in cuts], pa.int64()),
                pa.array([",".join(map(str, conv[a:b])) for a, b in spans], pa.string()),
            ],
            names=["seq", "words", "n", "conv_id", "ends"],
        )


def _join_equal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per sequence from its sorted runs; the hash of its conv_ids is fed run by run."""
    held: list = []

    def entry() -> tuple:
        seq, words, n, conv, digest = held
        return seq, words, n, conv, digest.hexdigest()

    for batch in batches:
        out = []
        for seq, words, n, conv, ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[0] == seq:
                held[2] += n
                held[4].update(b"," + ends.encode())
            else:
                if held:
                    out.append(entry())
                held[:] = seq, words, n, conv, hashlib.sha256(ends.encode())
        yield _rows(out, _ENTRY_SCHEMA)
    if held:
        yield _rows([entry()], _ENTRY_SCHEMA)


_ENTRY_SCHEMA = pa.schema([
    ("seq", pa.binary()), ("words", pa.binary()), ("n", pa.int64()), ("conv_id", pa.int64()), ("ends", pa.string()),
])
_NODE_SCHEMA = pa.schema([
    ("top", pa.bool_()), ("head", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()),
    ("parent_conv_id", pa.int64()), ("conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
])


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.record_batch([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def distinct_sequences(sequences: DataFrame) -> DataFrame:
    """``seq, words, n, conv_id, ends``: each sequence with its count, smallest conv_id and their hash.

    ``ends`` is the SHA-256 of the conv_ids in order. Copies meet first by ranges of
    conv_id, so that a sequence of very many conversations is a few packed rows afterwards.
    """
    near = sequences.select("conv_id", "seq", "words").repartitionByRange("conv_id").sortWithinPartitions("seq", "conv_id")
    runs = near.mapInArrow(_pack_equal, _ENTRY)
    return runs.repartition("seq").sortWithinPartitions("seq", "conv_id").mapInArrow(_join_equal, _ENTRY)


class _Open:
    """A node on the stack of a sweep."""

    __slots__ = ("words", "n", "conv", "leaves", "saved", "ends", "children")

    def __init__(self, words: int):
        self.words, self.n, self.conv, self.leaves, self.saved, self.ends = words, 0, None, 0, 0, NOTHING
        self.children: list[tuple] = []

    def add(self, n: int, conv: int) -> None:
        self.n += n
        self.conv = conv if self.conv is None else min(conv, self.conv)

    def sums(self) -> tuple:
        """The node's own columns, once all below it is in."""
        saved = self.saved + (self.n - 1) * self.words
        return self.conv, self.n, len(self.children), self.leaves or 1, saved, self.ends


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the containers in their order; a container's top node comes without its parent's conv_id."""
    out: list[tuple] = []
    stack: list[_Open] = []
    head = parent = None
    depth, last = 0, b""

    def close(to: int) -> None:
        while len(stack) > to:
            node = stack.pop()
            sums = node.sums()
            at = depth + len(stack)
            out.extend((False, None, None, at + 1, node.conv, *child) for child in node.children)
            node.children = []
            if not stack:
                out.append((True, head, parent, at, None, *sums))
                return
            above = stack[-1]
            above.add(node.n, node.conv)
            above.leaves += sums[3]
            above.saved += sums[4]
            above.children.append(sums)

    names = ("head", "parent", "depth", "last_words", "seq", "words", "n", "conv_id", "ends")
    for batch in batches:
        for own, up, at, top_words, seq, words, n, conv, ends in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if not stack or own != head:
                close(0)
                head, parent, depth, last = own, up, at, b""
                stack.append(_Open(top_words))
            common = len(os.path.commonprefix([last, seq])) // TURN
            close(common + 1)
            counts = np.frombuffer(words, "<i8").tolist()
            stack.extend(_Open(w) for w in counts[common:])
            last = seq
            stack[-1].add(n, conv)
            stack[-1].ends = ends
            if len(out) > 20_000:
                yield _rows(out, _NODE_SCHEMA)
                out.clear()
    close(0)
    yield _rows(out, _NODE_SCHEMA)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many turns the first and the last suffix of a container, and so all of it, share."""
    for batch in batches:
        pairs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
        both = [len(os.path.commonprefix(list(p))) // TURN for p in pairs]
        yield pa.record_batch([batch.column(0), pa.array(both, pa.int32())], names=["head", "shared"])


def _burst(entries: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None, DataFrame | None, DataFrame | None]:
    """One round: entries that stay, those that move, those that end at a burst chain, the burst heads."""
    sizes = entries.groupBy("head").agg(
        F.count("*").alias("entries"), F.min("seq").alias("low"), F.max("seq").alias("high")
    )
    large = write_once(
        sizes.where(F.col("entries") > limit).select("head", "low", "high").mapInArrow(_shared, "head binary, shared int")
    )
    if large.isEmpty():
        return entries, None, None, None
    stay = write_once(entries.join(large, "head", "left_anti"))
    moving = entries.join(large, "head")
    shared, length = F.col("shared"), (F.octet_length("seq") / TURN).cast("int")
    ends = write_once(moving.where(length == shared).select("head", "n", "conv_id", "ends"))
    step = F.substring("seq", F.lit(1), (shared + 1) * TURN)
    number = F.substring("words", shared * WORDS + 1, F.lit(WORDS))
    moved = moving.where(length > shared).select(
        F.unhex(F.md5(F.concat("head", step))).alias("head"),
        F.col("head").alias("parent"),
        (F.col("depth") + shared + 1).alias("depth"),
        _little(number).alias("last_words"),
        F.substring("seq", (shared + 1) * TURN + 1, F.octet_length("seq")).alias("seq"),
        F.substring("words", (shared + 1) * WORDS + 1, F.octet_length("words")).alias("words"),
        "n", "conv_id", "ends",
    )
    chain = F.substring("words", F.lit(1), shared * WORDS)
    # All entries of a head agree in these.
    heads = moving.groupBy("head").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("last_words").alias("last_words"),
        F.first("shared").alias("shared"), F.first(chain).alias("chain"),
    )
    return stay, write_once(moved), ends, write_once(heads)


def _little(number: Column) -> Column:
    """A number of eight bytes, the lowest first."""
    high_first = F.concat(*[F.hex(F.substring(number, k, 1)) for k in range(WORDS, 0, -1)])
    return F.conv(high_first, 16, 10).cast("long")


def _chain_nodes(heads: DataFrame, ends: DataFrame, tops: DataFrame) -> DataFrame:
    """Nodes of one round's burst heads, with ``place`` along the chain and ``bottom`` sums, from the tops below."""
    below = tops.groupBy(F.col("parent").alias("head")).agg(
        F.sum("n_convs").alias("n"), F.min("conv_id").alias("c"), F.count("*").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"),
    )
    own = ends.select("head", F.col("n").alias("n_ends"), F.col("conv_id").alias("c_ends"), "ends")
    joined = heads.join(below, "head").join(own, "head", "left")
    n = F.col("n") + F.coalesce("n_ends", F.lit(0))
    summed = joined.select(
        "head", "parent", "depth", "last_words", "shared", "chain", "n_children", "n_leaves", "saved",
        n.alias("n_convs"), F.least("c", "c_ends").alias("conv_id"), F.coalesce("ends", F.lit(NOTHING)).alias("ends"),
    )
    # Words of the nodes of the chain, the head's own first.
    along = F.concat(
        F.array("last_words"),
        F.when(F.col("shared") > 0, F.transform(
            F.sequence(F.lit(0), F.greatest("shared", F.lit(1)) - 1),
            lambda i: _little(F.substring("chain", i * WORDS + 1, F.lit(WORDS))),
        )).otherwise(F.array().cast("array<bigint>")),
    )
    placed = summed.withColumn("along", along).select("*", F.explode(F.sequence(F.lit(0), "shared")).alias("place"))
    bottom = F.col("place") == F.col("shared")
    rest = F.aggregate(F.slice("along", F.col("place") + 1, F.col("shared") - F.col("place") + 1), F.lit(0).cast("long"), lambda a, w: a + w)
    return placed.select(
        (F.col("place") == 0).alias("top"), "head", "parent",
        (F.col("depth") + F.col("place")).cast("long").alias("depth"),
        F.when(F.col("place") > 0, F.col("conv_id")).alias("parent_conv_id"), "conv_id", "n_convs",
        F.when(bottom, F.col("n_children")).otherwise(F.lit(1).cast("long")).alias("n_children"), "n_leaves",
        (F.col("saved") + (F.col("n_convs") - 1) * rest).alias("saved_tokens"),
        F.when(bottom, F.col("ends")).otherwise(F.lit(NOTHING)).alias("ends_sha256"),
    )


def prefix_trie(sequences: DataFrame, container: int = CONTAINER) -> DataFrame:
    """One row per distinct start of ``sequences`` (see :func:`turn_sequences`), the empty one included.

    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id`` (null for the root),
    ``n_convs`` (members), ``n_children``, ``n_leaves`` (childless nodes of the subtree),
    ``saved_tokens`` (over the subtree, each node's further members times the words of its
    last text; the root has none) and ``ends_sha256`` (of the members that end there).

    Containers of more than ``container`` entries burst; the result is the same for any.
    conv_ids must be distinct. A sequence without turns ends at the root. No sequences, no rows.
    """
    bound_batches(sequences.sparkSession)
    distinct = distinct_sequences(sequences)
    entries = write_once(distinct.select(
        F.lit(b"").alias("head"), F.lit(None).cast("binary").alias("parent"), F.lit(0).alias("depth"),
        F.lit(0).cast("long").alias("last_words"), "seq", "words", "n", "conv_id", "ends",
    ), large=True)
    settled, rounds = [], []
    while True:
        stay, moved, ends, heads = _burst(entries, container)
        settled.append(stay)
        if moved is None:
            break
        rounds.append((heads, ends))
        discard(entries)
        entries = moved
    rows = reduce(DataFrame.unionByName, settled)
    lined = rows.repartition("head").sortWithinPartitions("head", "seq")
    swept = write_once(lined.mapInArrow(_sweep, _NODE), large=True)
    discard(*settled)
    nodes, above = swept, []
    for heads, ends in reversed(rounds):
        made = write_once(_chain_nodes(heads, ends, nodes.where("top")))
        above.append((heads, made))
        nodes = nodes.unionByName(made)
    if not rounds:
        return nodes.select("conv_id", "depth", "parent_conv_id", *_SUM_NAMES)
    # The parent of a top node is the last node of its parent head's chain: the same members as that head.
    parents = reduce(DataFrame.unionByName, [made for _, made in above]).where("top").select(
        F.col("head").alias("parent"), F.col("conv_id").alias("above")
    )
    placed = nodes.where("top").join(parents, "parent", "left").withColumn("parent_conv_id", F.col("above"))
    done = nodes.where("NOT top").unionByName(placed.drop("above"))
    return done.select("conv_id", "depth", "parent_conv_id", *_SUM_NAMES)


_SUM_NAMES = ("n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
