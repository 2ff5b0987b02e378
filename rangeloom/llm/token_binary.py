"""Token-id output: one zstandard frame per document under a shared dictionary.

A store is a folder of three Parquet tables, so that any file system Spark can write will
do and a task that is run again cannot leave a half-written file behind:

* ``blocks``: ``shard, dictionary`` (sha256 of the dictionary the frames need), ``frames``
  (the documents' frames, end to end) and ``index``, which has for each document its id, the
  ``offset`` of its frame, its ``n_tokens`` and ``before``, the ids of the shard before it;
* ``dictionary``: ``sha256, content``; * ``shards``: ``shard, first_doc, n_tokens, start``.

A frame holds a document's ids as little-endian unsigned 32-bit integers. Documents are in
ascending order of doc_id over shards, blocks and index, so ``start + before`` counts the
ids of all documents before one. A short document costs the read of a block's index and
the decompression of its own frame only.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rangeloom.llm.common import LOWER_ASCII, bound_batches, texts_of, worker_state

#: Id that ends each document.
END_ID = 2
#: Size of the shared dictionary, and the sample it is trained on: about so many documents
#: of up to so many bytes, chosen by a hash of the id. It has a bearing on size only.
DICTIONARY_BYTES = 32 << 10
SAMPLE_DOCUMENTS = 400
SAMPLE_TEXT_BYTES = 16 << 10
#: A block is closed at so many bytes of frames.
BLOCK_BYTES = 1 << 20
LEVEL = 3

_INDEX = "array<struct<doc_id: bigint, offset: bigint, n_tokens: bigint, before: bigint>>"
_BLOCKS = f"shard int, dictionary string, frames binary, index {_INDEX}"
_BLOCK_SCHEMA = pa.schema([
    ("shard", pa.int32()), ("dictionary", pa.string()), ("frames", pa.binary()),
    ("index", pa.list_(pa.struct([(n, pa.int64()) for n in ("doc_id", "offset", "n_tokens", "before")]))),
])

# A full stop or comma after a letter, at the end of a word, is a token group of its own.
_WORD_END = re.compile(rb"([a-z]|\xc3[\xa0-\xb6\xb8-\xbf])([.,])(?=[ \n]|$)")


# Small letters of ASCII and Latin-1 only: no part of the tokenizer but its model has any effect.
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf])+\Z")
# Words by which a tokenizer is tried, whether that holds of it.
_TRIED = "a of the and word token ing été naïve çà über año señor straße øre x".split()


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in byte-level models: printable ones for themselves, others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


class Encoder:
    """Ids of texts by a tokenizer that drops white space and folds capitals.

    Such a tokenizer treats what stands between white space on its own, so each distinct
    piece is encoded once and remembered (up to ``limit`` pieces at a time, over all tasks
    of a worker). Texts that may hold special tokens go to the tokenizer whole.
    """

    def __init__(self, path: str, limit: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        state = worker_state()
        if path not in state:
            state[path] = (Tokenizer.from_file(path), {}, _byte_letters())
        (self.tokenizer, self.known, self.letters), self.limit = state[path], limit
        tried = [w.encode() for w in _TRIED if _PLAIN.match(w.encode())]
        self.plain = self._encode(tried) == [self._model(w) for w in tried]

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _model(self, word: bytes) -> bytes:
        """The ids of a plain word by the tokenizer's model alone."""
        tokens = self.tokenizer.model.tokenize(word.decode("latin-1").translate(self.letters))
        return array("I", [t.id for t in tokens]).tobytes()

    def _learn(self, words: list[bytes]) -> None:
        others = words
        if self.plain:
            others, match = [], _PLAIN.match
            for word in words:
                if match(word):
                    self.known[word] = self._model(word)
                else:
                    others.append(word)
        self.known.update(zip(others, self._encode(others), strict=True))

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        for start in range(0, len(texts), 500):
            split = [
                None if b"<|" in t else _WORD_END.sub(rb"\1 \2", t.translate(LOWER_ASCII)).split()
                for t in texts[start : start + 500]
            ]
            new = list({w for words in split if words for w in words}.difference(self.known))
            if len(self.known) + len(new) > self.limit:
                self.known.clear()
                new = list({w for words in split if words for w in words})
            self._learn(new)
            get = self.known.__getitem__
            for text, words in zip(texts[start : start + 500], split, strict=True):
                yield self._encode([text])[0] if words is None else b"".join(map(get, words))


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary trained on serialised id arrays; a plain prefix if they are too few."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES] or bytes(8)


def _write_blocks(batches: Iterator[pa.RecordBatch], path: str, dictionary: bytes, end_id: int) -> Iterator[pa.RecordBatch]:
    encoder, sha = Encoder(path), hashlib.sha256(dictionary).hexdigest()
    shared = zstandard.ZstdCompressionDict(dictionary)
    shared.precompute_compress(level=LEVEL)
    compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared).compress
    shard, end = TaskContext.get().partitionId(), np.array([end_id], "<u4").tobytes()
    frames, ids_of, sizes, counts, before = [], [], [], [], 0

    def block() -> pa.RecordBatch:
        """The block of the held frames; its index is made from whole columns."""
        nonlocal before
        n, size = np.array(counts, np.int64), np.array(sizes, np.int64)
        columns = [pa.array(ids_of, pa.int64()), np.cumsum(size) - size, n, before + np.cumsum(n) - n]
        index = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(_BLOCK_SCHEMA.field("index").type.value_type))
        before += int(n.sum())
        row = [pa.array([shard], pa.int32()), pa.array([sha]), pa.array([b"".join(frames)], pa.binary()),
               pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), index)]
        for held in (frames, ids_of, sizes, counts):
            held.clear()
        return pa.record_batch(row, schema=_BLOCK_SCHEMA)

    held = 0
    for batch in batches:
        for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts_of(batch.column(1))), strict=True):
            frame = compress(ids + end)
            frames.append(frame)
            ids_of.append(doc_id)
            sizes.append(len(frame))
            counts.append(len(ids) // 4 + 1)
            held += len(frame)
            if held >= BLOCK_BYTES:
                yield block()
                held = 0
    if frames:
        yield block()


def write_tokens(docs: DataFrame, target: str, tokenizer: str, *, end_id: int = END_ID) -> None:
    """Encode ``doc_id, text`` of ``docs`` into a store at ``target`` (which must not exist).

    Null and empty texts are one end id. A null doc_id comes first; rows that share an id
    are ordered by a hash of the text. An empty table gives a store without blocks.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    one_in = max(1, docs.count() // SAMPLE_DOCUMENTS)
    sample = (
        docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(one_in)) == 0)
        .select("text")
        .where(F.octet_length("text").between(1, SAMPLE_TEXT_BYTES))
        .limit(2 * SAMPLE_DOCUMENTS)
        .collect()
    )
    dictionary = train_dictionary(list(Encoder(tokenizer).encode([r[0].encode() for r in sample])))
    sha = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(sha, bytearray(dictionary))], "sha256 string, content binary").write.parquet(f"{target}/dictionary")
    (
        docs.select(F.col("doc_id").cast("long"), "text")
        .withColumn("spread", F.xxhash64("text"))  # rows of one id are dealt to several tasks
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), "spread")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "spread", "text")
        .drop("spread")
        .mapInArrow(lambda batches: _write_blocks(batches, tokenizer, dictionary, end_id), _BLOCKS)
        .write.parquet(f"{target}/blocks")
    )
    # One row per shard, so the running sum over shards may be one task's; their numbers are in order.
    shards = (
        spark.read.parquet(f"{target}/blocks")
        .select("shard", F.inline("index"))
        .groupBy("shard")
        .agg(F.min("doc_id").alias("first_doc"), F.sum("n_tokens").alias("n_tokens"))
    )
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards.select(
        "shard", "first_doc", "n_tokens", F.coalesce(F.sum("n_tokens").over(ahead), F.lit(0)).alias("start")
    ).write.parquet(f"{target}/shards")


def _dictionaries(spark: SparkSession, store: str) -> dict[str, bytes]:
    found = {r["sha256"]: bytes(r["content"]) for r in spark.read.parquet(f"{store}/dictionary").collect()}
    for sha, content in found.items():
        if hashlib.sha256(content).hexdigest() != sha:
            raise ValueError(f"dictionary {sha} of {store} is damaged")
    return found


def _decode(batches: Iterator[pa.RecordBatch], dictionaries: dict[str, bytes], wanted: set[int] | None, out: pa.Schema):
    known = {}
    for batch in batches:
        shards, shas, starts = (batch.column(i).to_pylist() for i in (0, 1, 4))
        for row, (shard, sha, start) in enumerate(zip(shards, shas, starts, strict=True)):
            if sha not in known:
                known[sha] = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionaries[sha])).decompress
            frames = memoryview(batch.column(2)[row].as_buffer())
            index = batch.column(3)[row].values
            docs = index.field("doc_id")
            at, counts, before = (index.field(n).to_numpy() for n in ("offset", "n_tokens", "before"))
            ends = np.append(at[1:], len(frames))
            places = np.arange(len(at))
            if wanted is not None:
                places = np.flatnonzero([d in wanted for d in docs.to_pylist()])
            found, sums = [], []
            for k in places.tolist():
                ids = known[sha](frames[at[k] : ends[k]], max_output_size=4 * int(counts[k]))
                if len(ids) != 4 * counts[k]:
                    raise ValueError(f"shard {shard}: document {docs[k]} has {len(ids)} bytes of ids")
                sums.append(zlib.crc32(ids))
                if "ids" in out.names:
                    found.append(np.frombuffer(ids, "<u4").astype(np.int64))
            columns = [docs.take(pa.array(places)), start + before[places], counts[places], np.array(sums, np.int64)]
            if "ids" in out.names:
                ends_of = np.cumsum([0, *map(len, found)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(ends_of, np.concatenate([np.empty(0, np.int64), *found])))
            yield pa.record_batch([pa.array(c, t) if isinstance(c, np.ndarray) else c for c, t in zip(columns, out.types, strict=True)], schema=out)


def _read(spark: SparkSession, store: str, wanted: set[int] | None, ids: bool) -> DataFrame:
    names = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    out = pa.schema(names + [("ids", pa.list_(pa.int64()))] * ids)
    blocks = spark.read.schema(_BLOCKS).parquet(f"{store}/blocks")
    if wanted is not None:
        near = F.exists("index", lambda e: e["doc_id"].isin(sorted(wanted)))
        blocks = blocks.where(near)
    dictionaries = _dictionaries(spark, store)
    bound_batches(spark)
    started = blocks.join(spark.read.parquet(f"{store}/shards").select("shard", "start"), "shard")
    return started.select("shard", "dictionary", "frames", "index", "start").mapInArrow(
        lambda batches: _decode(batches, dictionaries, wanted, out),
        "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * ids,
    )


def token_digests(spark: SparkSession, store: str) -> DataFrame:
    """Per document of a store: ``doc_id, start, n_tokens, ids_crc32``, from its frame."""
    return _read(spark, store, None, ids=False)


def read_tokens(spark: SparkSession, store: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The same and the ids themselves, of all documents or a few given ones."""
    return _read(spark, store, None if doc_ids is None else set(doc_ids), ids=True)
