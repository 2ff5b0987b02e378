"""Removal of repeated passages, found by difference-cover anchors.

A document's words are numbered from 0. Anchors are hashes of :data:`ANCHOR` words, taken
only where the number modulo :data:`PERIOD` is in :data:`COVER`. The cover has every
difference modulo the period, so two equal runs of ``ANCHOR + PERIOD - 1`` words or more,
wherever they start, have an anchor at the same place within them. Anchors in more than
one document are then extended: all windows of that length around them are compared, by
128 bits of hash, and a window goes if it also starts in a document with a smaller id.

Nothing is compared pair by pair. Documents are held in groups of bounded size. A group
sends each distinct anchor once, to the part of its hash range, and gets back a bit for each:
whether another group has it, too. It sends each distinct window around shared anchors once,
with its smallest doc_id, and gets back whether another group has a smaller one. So a
passage in a third of all documents is one entry per group, and nothing is broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangeloom.llm.common import LARGE_ROWS, Words, bound_batches, fold_table, mixed, trim, window_hashes, write_once

#: Words of a window.
WINDOW = 13
#: Every difference modulo 7 is one of two numbers of the cover.
PERIOD, COVER = 7, (1, 2, 4)
ANCHOR = WINDOW - PERIOD + 1
#: Bytes of text of a group (a longer text is a group alone), and of the entries of a part.
GROUP_BYTES = 4 << 20
PART_BYTES = 8 << 20

_FOLD = fold_table(lambda c: not (c == 0x20 or 0x09 <= c <= 0x0D), lower=False)
_SECOND = np.uint64(0xA0761D6478BD642F)  # tells the second hash of a window from the first

_GROUP = "g bigint, ids array<bigint>, texts array<binary>, bytes bigint"
_BITS = "g bigint, part bigint, bits binary"


def _group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents in groups of :data:`GROUP_BYTES`, numbered by task and order."""
    number = TaskContext.get().partitionId() << 32
    ids: list[int] = []
    texts: list[bytes] = []
    size = 0

    def group() -> pa.RecordBatch:
        return pa.record_batch(
            [[number], pa.array([ids], pa.list_(pa.int64())), pa.array([texts], pa.list_(pa.binary())), [size]],
            names=["g", "ids", "texts", "bytes"],
        )

    for batch in batches:
        trim()
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if texts and size + len(text) > GROUP_BYTES:
                yield group()
                ids, texts, size, number = [], [], 0, number + 1
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
    if texts:
        yield group()


def _groups_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """``(g, ids, texts, ...)`` of the rows of a batch, one at a time."""
    for row in range(batch.num_rows):
        trim()
        ids, texts = batch.column(1)[row].values, batch.column(2)[row].values
        yield (batch.column(0)[row].as_py(), ids.to_numpy(), texts.to_pylist(), *(c[row].as_py() for c in batch.columns[3:]))


class _Anchored:
    """The words of a group's texts, and their anchors."""

    def __init__(self, texts: list[bytes]):
        self.words = Words(texts, _FOLD)
        self.places, found = [], [np.empty(0, np.uint64)]
        for k in range(len(texts)):
            own = self.words.hashes[self.words.of(k)]
            at = np.arange(len(own) - ANCHOR + 1 if len(own) >= WINDOW else 0)
            at = at[np.isin(at % PERIOD, COVER)]
            self.places.append(at)
            found.append(window_hashes(own, ANCHOR)[at] if len(at) else found[0])
        self.distinct, self.which = np.unique(np.concatenate(found), return_inverse=True)

    def windows(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the windows around shared anchors: two hashes each, text and start of each."""
        firsts, seconds, owners, starts, at = [], [], [], [], 0
        for k, places in enumerate(self.places):
            near = places[shared[self.which[at : at + len(places)]]]
            at += len(places)
            if not len(near):
                continue
            own = self.words.hashes[self.words.of(k)]
            begin = np.unique((near[:, None] - np.arange(PERIOD)).ravel())
            begin = begin[(begin >= 0) & (begin <= len(own) - WINDOW)]
            firsts.append(window_hashes(own, WINDOW)[begin])
            seconds.append(window_hashes(mixed(own ^ _SECOND), WINDOW)[begin])
            owners.append(np.full(len(begin), k))
            starts.append(begin)
        if not firsts:
            return np.empty((2, 0), np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        return np.stack([np.concatenate(firsts), np.concatenate(seconds)]), np.concatenate(owners), np.concatenate(starts)


def _distinct(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of hashes in order, and the number of each window's pair."""
    order = np.lexsort((windows[1], windows[0]))
    ordered = windows[:, order]
    new = np.concatenate([[True], (ordered[:, 1:] != ordered[:, :-1]).any(axis=0)])[: len(order)]
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return ordered[:, new], which


def _parts(hashes: np.ndarray, parts: int) -> Iterator[tuple[int, slice]]:
    """Stretches of sorted hashes by the part of the hash range they are in."""
    part = ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(hashes)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if a < b:
            yield int(part[a]), slice(a, b)


_ANCHORS = pa.schema([("part", pa.int64()), ("g", pa.int64()), ("hashes", pa.binary())])
_WINDOWS = pa.schema([("part", pa.int64()), ("g", pa.int64()), ("hashes", pa.binary()), ("base", pa.int64()), ("least", pa.binary())])


def _send_anchors(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for g, _, texts, *_ in _groups_of(batch):
            found = _Anchored(texts).distinct
            rows = [{"part": p, "g": g, "hashes": found[s].tobytes()} for p, s in _parts(found, parts)]
            yield pa.RecordBatch.from_pylist(rows, schema=_ANCHORS)


def _bits(g: list[int], part: int, marks: list[np.ndarray]) -> pa.Table:
    packed = [np.packbits(m, bitorder="little").tobytes() for m in marks]
    return pa.table({"g": pa.array(g, pa.int64()), "part": pa.array([part] * len(g), pa.int64()), "bits": pa.array(packed, pa.binary())})


def _shared_anchors(table: pa.Table) -> pa.Table:
    """For each group's anchors of a part, whether another group has them."""
    trim()
    own = [np.frombuffer(h, np.uint64) for h in table.column("hashes").to_pylist()]
    _, which, counts = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
    several = (counts > 1)[which]
    return _bits(table.column("g").to_pylist(), table.column("part")[0].as_py(), np.split(several, np.cumsum([len(o) for o in own])[:-1]))


def _flags(bits: list[dict] | None, sizes: list[tuple[int, slice]], n: int) -> np.ndarray:
    """The bits of a group's entries, from those of its parts."""
    out = np.zeros(n, bool)
    known = {b["part"]: b["bits"] for b in bits or []}
    for part, stretch in sizes:
        if part in known:
            size = stretch.stop - stretch.start
            out[stretch] = np.unpackbits(np.frombuffer(known[part], np.uint8), count=size, bitorder="little").astype(bool)
    return out


def _local(anchored: _Anchored) -> np.ndarray:
    """Anchors that several texts of the group have, or one text twice."""
    return np.bincount(anchored.which, minlength=len(anchored.distinct)) > 1


def _extended(texts: list[bytes], ids: np.ndarray, bits: list[dict] | None, parts: int):
    anchored = _Anchored(texts)
    shared = _flags(bits, list(_parts(anchored.distinct, parts)), len(anchored.distinct)) | _local(anchored)
    windows, owner, start = anchored.windows(shared)
    distinct, which = _distinct(windows)
    least = np.full(distinct.shape[1], np.iinfo(np.int64).max)
    np.minimum.at(least, which, ids[owner])
    return anchored, owner, start, distinct, which, least


def _send_windows(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for g, ids, texts, bits in _groups_of(batch):
            *_, distinct, _, least = _extended(texts, ids, bits, parts)
            base = int(ids.min())
            width = np.uint32 if int(ids.max()) - base < 2**32 else np.int64
            rows = []
            for p, s in _parts(distinct[0], parts):
                pairs, own = np.ascontiguousarray(distinct[:, s].T), (least[s] - base).astype(width)
                rows.append({"part": p, "g": g, "hashes": pairs.tobytes(), "base": base, "least": own.tobytes()})
            yield pa.RecordBatch.from_pylist(rows, schema=_WINDOWS)


def _earlier_windows(table: pa.Table) -> pa.Table:
    """For each group's windows of a part, whether another group has them with a smaller id."""
    trim()
    pairs, least = [], []
    for h, base, own in zip(*(table.column(c).to_pylist() for c in ("hashes", "base", "least")), strict=True):
        pairs.append(np.frombuffer(h, np.uint64).reshape(-1, 2))
        width = np.uint32 if len(own) == 4 * len(pairs[-1]) else np.int64
        least.append(np.frombuffer(own, width).astype(np.int64) + base)
    distinct, which = _distinct(np.concatenate(pairs).T)
    least_of = np.full(distinct.shape[1], np.iinfo(np.int64).max)
    every = np.concatenate(least)
    np.minimum.at(least_of, which, every)
    marks = np.split(least_of[which] < every, np.cumsum([len(p) for p in pairs])[:-1])
    return _bits(table.column("g").to_pylist(), table.column("part")[0].as_py(), marks)


_OUT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string"
_OUT_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
    ("kept_text", pa.string()),
])


def _kept(doc_id: int | None, text: bytes, n_words: int, hit: np.ndarray) -> tuple:
    """A document without the words that a hit window covers; ``hit`` has the windows' starts."""
    cover = np.zeros(n_words + 1, np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + WINDOW, -1)
    keep = np.cumsum(cover[:-1]) == 0
    kept = b" ".join(w for w, x in zip(text.split(), keep.tolist(), strict=True) if x)
    return doc_id, n_words, int((~keep).sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(_OUT_SCHEMA)
    return pa.record_batch([pa.array(list(c), t.type) for c, t in zip(columns, _OUT_SCHEMA, strict=True)], schema=_OUT_SCHEMA)


def _remove(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, ids, texts, anchor_bits, window_bits in _groups_of(batch):
            anchored, owner, start, distinct, which, least = _extended(texts, ids, anchor_bits, parts)
            earlier = _flags(window_bits, list(_parts(distinct[0], parts)), distinct.shape[1])
            hit = (earlier[which] | (least[which] < ids[owner])) if len(which) else np.empty(0, bool)
            owner, start = owner[hit], start[hit]
            first = np.searchsorted(owner, np.arange(len(texts) + 1))
            rows = []
            for k, text in enumerate(texts):
                own = anchored.words.of(k)
                rows.append(_kept(int(ids[k]), text, own.stop - own.start, start[first[k] : first[k + 1]]))
            yield _rows(rows)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents without an id, as they are."""
    for batch in batches:
        texts = batch.column(0).to_pylist()
        words = Words(texts, _FOLD)
        sizes = [words.of(k).stop - words.of(k).start for k in range(len(texts))]
        yield _rows([_kept(None, t, n, np.empty(0, np.int64)) for t, n in zip(texts, sizes, strict=True)])


def _by_group(bits: DataFrame, name: str) -> DataFrame:
    return bits.groupBy("g").agg(F.collect_list(F.struct("part", "bits")).alias(name))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept_text`` for every row of ``docs``.

    Reads ``doc_id, text``. Words are runs of anything but space and U+0009 to U+000D. A
    word goes if a window of :data:`WINDOW` words of its document that covers it also starts
    in a document with a smaller id; windows are judged on the input. ``kept_text`` is the
    kept words joined by a space. Windows are equal if 128 bits of hash are.

    Null and empty texts have no words. A null doc_id has no order: such documents stay
    whole and remove nothing elsewhere. Rows that share an id never remove from each other.
    An empty table gives no rows; other columns are left out.
    """
    bound_batches(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    docs = docs.select(F.col("doc_id").cast("long"), text)
    groups = write_once(docs.where("doc_id IS NOT NULL").mapInArrow(_group, _GROUP), options=LARGE_ROWS)
    size = groups.agg(F.sum("bytes")).first()[0] or 0
    parts = max(16, size // PART_BYTES)
    columns = ["g", "ids", "texts"]
    sent = groups.select(*columns).mapInArrow(lambda b: _send_anchors(b, parts), "part bigint, g bigint, hashes binary")
    anchors = write_once(sent.groupBy("part").applyInArrow(_shared_anchors, _BITS), large=True)
    held = groups.select(*columns).join(_by_group(anchors, "anchors"), "g", "left")
    sent = held.mapInArrow(
        lambda b: _send_windows(b, parts), "part bigint, g bigint, hashes binary, base bigint, least binary"
    )
    windows = write_once(sent.groupBy("part").applyInArrow(_earlier_windows, _BITS), large=True)
    held = groups.select(*columns).join(_by_group(anchors, "anchors"), "g", "left").join(_by_group(windows, "windows"), "g", "left")
    return held.mapInArrow(lambda b: _remove(b, parts), _OUT).unionByName(
        docs.where("doc_id IS NULL").select("text").mapInArrow(_whole, _OUT)
    )
