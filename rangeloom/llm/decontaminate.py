"""Benchmark decontamination: an FM-index per shard of documents, searched for test phrases.

A task cuts the documents it is given into shards of a bounded number of words, indexes
each shard, searches all phrases backward, locates what is found and merges the places of
a document into removal spans. Documents are never shuffled. The phrases are the query
set: they go to the tasks in blocks of bounded size, searched one after the other.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangeloom.llm.common import Words, bound_batches, fold_table, texts_of
from rangeloom.llm.fm_index import FMIndex

#: Words of a phrase; an item of fewer words is one phrase of all its words.
WINDOW = 10
#: Words in the index of one shard (about 150 MB while it is built).
SHARD_WORDS = 1 << 20
#: Bytes of benchmark text in one block of phrases.
BLOCK_BYTES = 4 << 20

# Small letters, digits and all bytes of non-ASCII characters stay, the rest separates words.
_FOLD = fold_table(lambda c: c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A, lower=True)

_OUT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
    ("items", pa.list_(pa.string())),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
])
SCHEMA = (
    "doc_id bigint, n_words bigint, n_hit bigint, items array<string>, "
    "spans array<struct<start: bigint, end: bigint>>"
)


class Phrases:
    """Distinct phrases of a block of items, by length, and the items each belongs to."""

    def __init__(self, items: Iterable[tuple[str, bytes]]):
        owners = {}
        for item, text in items:
            words = Words([text], _FOLD).hashes
            size = min(WINDOW, len(words))
            for i in range(len(words) - size + 1 if size else 0):
                owners.setdefault(tuple(words[i : i + size].tolist()), set()).add(item)
        self.groups: list[tuple[np.ndarray, list[list[str]]]] = []
        for size in sorted({len(p) for p in owners}):
            some = [p for p in owners if len(p) == size]
            self.groups.append((np.array(some, np.uint64), [sorted(owners[p]) for p in some]))


class _Document:
    __slots__ = ("doc_id", "hit", "items", "n_words", "places", "text")

    def __init__(self, doc_id, text: bytes, places: tuple[np.ndarray, np.ndarray]):
        self.doc_id, self.text, self.places, self.n_words = doc_id, text, places, len(places[0])
        self.hit: np.ndarray | None = None
        self.items: set[str] = set()

    def spans(self) -> list[dict]:
        """Runs of hit words as ``[start, end)`` in characters."""
        if self.hit is None:
            return []
        edges = np.flatnonzero(np.diff(np.concatenate([[False], self.hit, [False]]).astype(np.int8)))
        starts, ends = self.places
        out, done, chars = [], 0, 0
        for first, last in zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True):
            a, b = int(starts[first]), int(ends[last])
            start = chars + len(self.text[done:a].decode("utf-8", "replace"))
            chars, done = start + len(self.text[a:b].decode("utf-8", "replace")), b
            out.append({"start": start, "end": chars})
        return out


def _search_shard(shard: list[tuple[_Document, int, np.ndarray]], blocks) -> None:
    """Mark the hit words and the items of the documents whose pieces make up the shard."""
    index = FMIndex([piece for _, _, piece in shard])
    marks = np.zeros(index.n + 1, np.int32)
    for block in blocks:
        for phrases, owners in block.value:
            which, at = index.occurrences(phrases)
            np.add.at(marks, at, 1)
            np.add.at(marks, at + phrases.shape[1], -1)
            piece = np.searchsorted(index.starts, at, "right") - 1
            for pair in np.unique(piece * len(phrases) + which).tolist():
                shard[pair // len(phrases)][0].items.update(owners[pair % len(phrases)])
    hit = np.cumsum(marks) > 0
    bounds = np.append(index.starts, index.n)
    some = np.add.reduceat(hit[: index.n], index.starts)
    for k in np.flatnonzero(some).tolist():
        document, offset, piece = shard[k]
        if document.hit is None:
            document.hit = np.zeros(document.n_words, bool)
        document.hit[offset : offset + len(piece)] |= hit[bounds[k] : bounds[k] + len(piece)]


def _shards(batches: Iterator[pa.RecordBatch], blocks, shard_words: int) -> Iterator[pa.RecordBatch]:
    shard, documents, size = [], [], 0

    def flush() -> pa.RecordBatch:
        if shard:
            _search_shard(shard, blocks)
        rows = [
            (d.doc_id, d.n_words, 0 if d.hit is None else int(d.hit.sum()), sorted(d.items), d.spans())
            for d in documents
        ]
        columns = list(zip(*rows, strict=True))
        return pa.record_batch([pa.array(c, t.type) for c, t in zip(columns, _OUT, strict=True)], schema=_OUT)

    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), texts_of(batch.column(1))
        split = Words(texts, _FOLD)
        for k, (doc_id, text) in enumerate(zip(ids, texts, strict=True)):
            own, at = split.of(k), split.text_at[k]
            words = split.hashes[own]
            document = _Document(doc_id, text, (split.starts[own] - at, split.ends[own] - at))
            documents.append(document)
            # A text longer than a shard goes in pieces that share all but one word of a phrase.
            for start in range(0, len(words), shard_words):
                piece = words[start : start + shard_words + WINDOW - 1]
                shard.append((document, start, piece))
                size += len(piece)
                if start + shard_words < len(words):
                    _search_shard(shard, blocks)
                    shard, size = [], 0
            if size >= shard_words or len(documents) >= 50_000:
                yield flush()
                shard, documents, size = [], [], 0
    if documents:
        yield flush()


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, shard_words: int = SHARD_WORDS) -> DataFrame:
    """What of each document is found in ``benchmark``.

    Reads ``doc_id, text`` of the documents and ``item_id, text`` of the benchmark. Words
    are runs of ASCII letters and digits (capitals as small letters) and non-ASCII
    characters. A phrase is :data:`WINDOW` consecutive words of an item, or all of a
    shorter one. One row per document: ``doc_id``, ``n_words``, ``n_hit`` (words inside
    any phrase found), ``items`` (ids, as sorted texts) and ``spans`` (merged removal
    spans in characters, end excluded).

    Null and empty texts have no words and no hits; items without words find nothing, an
    item with a null id is searched under the id "null". Repeated rows give repeated rows.
    """
    benchmark = benchmark.where("text is not null").select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text"
    )
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, math.ceil(total / BLOCK_BYTES))
    context = docs.sparkSession.sparkContext
    blocks = []
    for k in range(n_blocks):
        rows = benchmark.where(F.pmod(F.hash("item", "text"), F.lit(n_blocks)) == k).collect()
        blocks.append(context.broadcast(Phrases((r["item"], r["text"].encode()) for r in rows).groups))
    bound_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda batches: _shards(batches, blocks, shard_words), SCHEMA
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) without those that hold a phrase of ``benchmark``.

    Only ids of documents with removal spans go through the shuffle; a null doc_id is an
    id like any other, so rows that share an id go together.
    """
    found = decontaminate(docs, benchmark).where("n_hit > 0").select(F.col("doc_id").alias("__hit")).distinct()
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col("__hit")), "left_anti")


def excise(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """``text`` without the spans of :func:`decontaminate`."""
    if not text:
        return text
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at:start])
        at = end
    return "".join([*kept, text[at:]])
