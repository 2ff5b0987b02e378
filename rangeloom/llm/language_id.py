"""Language identification, words first.

A known word scores by its log frequency in each language. A word that is not known backs
off to its character n-grams, the longest length first, until some of them are known. A
document's score is the sum over its words.

Words are runs of letters of the lower-cased text. Counts cover every labelled document,
those of n-grams every word of it, rare and long ones too. The model has an entry for each
of a language's most frequent words and n-grams, so its size is bounded, and an entry has
its count in every language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rangeloom.llm.common import bound_batches, mixed, shared, trim, worker_state, write_once

#: Words and n-grams that each language chooses for the model, at most.
MODEL_WORDS = 40_000
MODEL_GRAMS = 40_000
#: Length of the longest and shortest n-grams that unseen words back off to.
LONGEST, SHORTEST = 5, 1
SMOOTHING = 0.5
#: Words of more characters give their n-grams where they are counted, shorter ones afterwards,
#: once for each distinct word. The counts are the same.
LONG_WORD = 40
#: What a text without letters is.
UNKNOWN = "und"
#: Characters handled at a time.
CHUNK = 1 << 20

_FACTOR = np.uint64(0xD6E8FEB86659FD93)
_EDGE = 32  # stands before and after a word in its n-grams
_HASH_LEVELS = 10  # bits of a hash by which equal counts are ordered


def _letters() -> np.ndarray:
    """Whether each code point is a letter; made once in a worker."""
    state = worker_state()
    if "letters" not in state:
        state["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return state["letters"]


def _powers(n: int) -> np.ndarray:
    state = worker_state()
    if ("powers", n) not in state:
        more = np.cumprod(np.full(n - 1, _FACTOR, np.uint64), dtype=np.uint64)
        state["powers", n] = np.concatenate([[np.uint64(1)], more])
    return state["powers", n]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(codes) + 2, np.int8)
    inside[1:-1] = _letters()[codes]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def _run_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the characters of each run."""
    sizes = ends - starts
    begin = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(begin, sizes)
    at = place + np.repeat(starts, sizes)
    powers = _powers(1 << 12)
    value = mixed(codes[at].astype(np.uint64) + np.uint64(1)) * powers[place & 4095]
    value += (place >> 12).astype(np.uint64)
    return mixed(np.add.reduceat(value, begin) + sizes.astype(np.uint64))


def _chunks(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(codes, starts, ends, text number)`` of the words of texts, some texts at a time.

    A text longer than a chunk is cut between words.
    """
    parts, owners, size = [], [], 0

    def chunk():
        codes = _codes("\n".join(parts))
        starts, ends = _runs(codes)
        bounds = np.cumsum([len(p) + 1 for p in parts])
        return codes, starts, ends, np.array(owners)[np.searchsorted(bounds, starts, "right")]

    for k, text in enumerate(texts):
        low, at = (text or "").lower(), 0
        while at < len(low):
            end = at + CHUNK
            while end < len(low) and low[end - 1].isalpha() and low[end].isalpha() and end < at + 2 * CHUNK:
                end += 1
            parts.append(low[at:end])
            owners.append(k)
            size += len(parts[-1])
            at = end
            if size >= CHUNK:
                yield chunk()
                parts, owners, size = [], [], 0
    if parts:
        yield chunk()


def _edged(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words with their edges, one after another, and the size of each."""
    sizes = ends - starts + 2
    begin = np.cumsum(sizes) - sizes
    inner = sizes - 2
    place = np.arange(int(inner.sum())) - np.repeat(np.cumsum(inner) - inner, inner)
    edged = np.full(int(sizes.sum()), _EDGE, np.uint32)
    edged[np.repeat(begin, inner) + 1 + place] = codes[np.repeat(starts, inner) + place]
    return edged, sizes


def _grams(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each n-gram of words with edges: the number of its word, and where it starts."""
    grams = np.maximum(sizes - length + 1, 0)
    word = np.repeat(np.arange(len(sizes)), grams)
    shift = np.arange(int(grams.sum())) - np.repeat(np.cumsum(grams) - grams, grams)
    return word, (np.cumsum(sizes) - sizes)[word] + shift


def _tally(
    langs: list[str], length: int, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, lang: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """``(lang, length, text, n)`` of runs of characters."""
    if not len(starts):
        return
    keys = _run_hashes(codes, starts, ends) + mixed(lang.astype(np.uint64) + np.uint64(7))
    _, first, n = np.unique(keys, return_index=True, return_counts=True)
    text = codes.tobytes().decode("utf-32-le", "surrogatepass")
    texts = [text[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
    yield pa.record_batch(
        [
            pa.array([langs[k] for k in lang[first]], pa.string()), pa.array([length] * len(first), pa.int32()),
            pa.array(texts, pa.string()), pa.array(n, pa.int64()),
        ],
        names=["lang", "length", "text", "n"],
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(lang, length, text, n)`` of a batch: counts are combined before they are shuffled.

    Words have length 0. Long ones give their n-grams here.
    """
    for batch in batches:
        trim()
        names = batch.column(0).to_pylist()
        langs = sorted(set(names))
        lang_of = np.array([langs.index(x) for x in names])
        for codes, starts, ends, owner in _chunks(batch.column(1).to_pylist()):
            lang = lang_of[owner]
            yield from _tally(langs, 0, codes, starts, ends, lang)
            long = ends - starts > LONG_WORD
            edged, sizes = _edged(codes, starts[long], ends[long])
            for length in range(SHORTEST, LONGEST + 1):
                word, first = _grams(sizes, length)
                yield from _tally(langs, length, edged, first, first + length, lang[long][word])


def _most_frequent(counts: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` rows with the highest ``n`` of each ``lang`` and ``length``, or all there are.

    Equal ones are taken by a hash of the text, then by the text. Bounds are found on the
    counts of counts, which are few, then on the counts of hashes, instead of by sorting.
    """
    keys = ["lang", "length", "room"]

    def cut(rows: DataFrame, level: Column) -> tuple[DataFrame, DataFrame]:
        """Rows of the levels that fit whole, and those of the first that does not, with the room left."""
        levels = rows.groupBy(*keys, level.alias("level")).agg(F.count("*").alias("rows"))
        upto = F.sum("rows").over(Window.partitionBy(*keys).orderBy("level"))
        bounds = (
            levels.withColumn("upto", upto).where("upto > room")
            .groupBy(*keys).agg(F.min(F.struct("level", (F.col("room") - F.col("upto") + F.col("rows")).alias("left"))).alias("at"))
        )
        bounds = write_once(bounds)  # a few rows; else every branch of the plan holds their steps again
        placed = rows.join(F.broadcast(bounds), keys, "left")
        whole = placed.where(F.col("at").isNull() | (level < F.col("at.level")))
        return whole.select(*counts.columns), placed.where(level == F.col("at.level")).select(*counts.columns, F.col("at.left").alias("room"))

    above, equal = cut(counts.withColumn("room", F.lit(keep).cast("long")), -F.col("n"))
    first, last = cut(equal, F.shiftrightunsigned(F.xxhash64("text"), 64 - _HASH_LEVELS))
    place = F.row_number().over(Window.partitionBy("lang", "length").orderBy("text"))
    return above.union(first).union(last.withColumn("place", place).where("place <= room").select(*counts.columns))


def _entries(counts: DataFrame, keep: int) -> dict[int, list[tuple[str, str, int]]]:
    """By length, ``(lang, text, n)`` of every language for each text that one of them chooses."""
    chosen = write_once(_most_frequent(counts, keep)).select("length", "text").distinct()
    found = counts.join(F.broadcast(chosen), ["length", "text"], "left_semi").select("length", "lang", "text", "n").toArrow()
    rows: dict[int, list[tuple[str, str, int]]] = {}
    for batch in found.to_batches():
        for length, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            rows.setdefault(length, []).append(tuple(row))
    return rows


@dataclass
class Model:
    """Log frequencies per language: of known words (length 0) and of n-grams by length."""

    langs: list[str]
    tables: dict[int, tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def table(rows: list[tuple[str, str, int]], langs: list[str], totals: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        texts = sorted({text for _, text, _ in rows})
        place = {text: i for i, text in enumerate(texts)}
        counts = np.zeros((len(texts), len(langs)))
        for lang, text, n in rows:
            counts[place[text], langs.index(lang)] += n
        all_of = np.array([totals.get(x, 0) for x in langs]) + SMOOTHING * (len(texts) + 1)
        logs = np.log((counts + SMOOTHING) / all_of)
        codes = _codes("".join(texts))
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        hashes = _run_hashes(codes, ends - [len(t) for t in texts], ends) if texts else np.empty(0, np.uint64)
        by = np.argsort(hashes)
        return hashes[by], logs[by].astype(np.float32)

    def look_up(self, length: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are known, and the rows of those."""
        known, logs = self.tables[length]
        if not len(known):
            return np.zeros(len(hashes), bool), logs[:0]
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        hit = known[at] == hashes
        return hit, logs[at[hit]]

    def word_scores(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A log score per word and language; zeros for a word nothing is known of."""
        scores = np.zeros((len(starts), len(self.langs)), np.float32)
        _, one, back = np.unique(_run_hashes(codes, starts, ends), return_index=True, return_inverse=True)
        starts, ends = starts[one], ends[one]
        own = np.zeros((len(one), len(self.langs)), np.float32)
        hit, logs = self.look_up(0, _run_hashes(codes, starts, ends))
        own[hit] = logs
        unseen = np.flatnonzero(~hit)
        for length in range(LONGEST, SHORTEST - 1, -1):
            edged, sizes = _edged(codes, starts[unseen], ends[unseen])
            word, first = _grams(sizes, length)
            if not len(word):
                continue
            hit, logs = self.look_up(length, _run_hashes(edged, first, first + length))
            total = np.zeros((len(unseen), len(self.langs)))
            np.add.at(total, word[hit], logs)
            known = np.bincount(word[hit], minlength=len(unseen))
            some = known > 0
            own[unseen[some]] = total[some] / known[some, None]
            unseen = unseen[~some]
            if not len(unseen):
                break
        scores[:] = own[back]
        return scores


def held_out(doc_id: str) -> Column:
    """Documents that nothing is learned from; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, *, model_words: int = MODEL_WORDS, model_grams: int = MODEL_GRAMS) -> Model:
    """A model from ``lang`` and ``text`` of all rows where both are set.

    All words and n-grams are counted; of those, each language chooses the ``model_words``
    and ``model_grams`` most frequent ones, which bounds what is sent to the tasks. A word
    that no language chose scores by its n-grams, as an unseen one does.
    """
    bound_batches(docs.sparkSession)
    counts = write_once(
        docs.where("lang is not null and text is not null")
        .select("lang", "text")
        .mapInArrow(_count, "lang string, length int, text string, n bigint")
        .groupBy("lang", "length", "text")
        .agg(F.sum("n").alias("n"))
    )
    words = counts.where("length = 0")
    edged = F.concat(F.lit(chr(_EDGE)), F.col("text"), F.lit(chr(_EDGE)))
    grams = words.where(F.length("text") <= LONG_WORD).select(
        "lang", "n", edged.alias("edged"),
        F.explode(F.array(*[F.lit(k) for k in range(SHORTEST, LONGEST + 1)])).alias("length"),
    ).where(F.length("edged") >= F.col("length"))
    grams = grams.select(
        "lang", "length",
        F.explode(F.expr("transform(sequence(1, length(edged) - length + 1), i -> substr(edged, i, length))")).alias("text"),
        "n",
    ).union(counts.where("length > 0").select("lang", "length", "text", "n"))
    grams = write_once(grams.groupBy("lang", "length", "text").agg(F.sum("n").alias("n")))
    totals: dict[int, dict[str, int]] = {}
    for r in words.union(grams.select(*words.columns)).groupBy("lang", "length").agg(F.sum("n").alias("n")).collect():
        totals.setdefault(r["length"], {})[r["lang"]] = r["n"]
    langs = sorted({x for of in totals.values() for x in of})
    rows = _entries(words, model_words) | _entries(grams, model_grams // LONGEST)
    lengths = [0, *range(SHORTEST, LONGEST + 1)]
    return Model(langs, {k: Model.table(rows.pop(k, []), langs, totals.get(k, {})) for k in lengths})


def _predict(batches: Iterator[pa.RecordBatch], model: Model, columns: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        trim()
        texts = batch.column(columns).to_pylist()
        sums = np.zeros((len(texts), len(model.langs)))
        words = np.zeros(len(texts), np.int64)
        for codes, starts, ends, owner in _chunks(texts):
            if len(starts):
                np.add.at(sums, owner, model.word_scores(codes, starts, ends))
                words += np.bincount(owner, minlength=len(texts))
        if model.langs:
            share = np.exp(sums - sums.max(axis=1, keepdims=True))
            share /= share.sum(axis=1, keepdims=True)
            best = share.argmax(axis=1)
            lang = [model.langs[b] if n else UNKNOWN for b, n in zip(best, words, strict=True)]
            score = np.where(words > 0, share[np.arange(len(texts)), best], 0.0)
        else:
            lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        kept = [batch.column(i) for i in range(columns)]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(lang, pa.string()), pa.array(score, pa.float64())],
            names=[*batch.schema.names[:columns], "lang_pred", "score"],
        )


def predict(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """Columns ``keep`` of ``docs``, ``lang_pred`` and ``score`` from ``text`` alone.

    ``score`` is the share of the predicted language (0 to 1). A null text, or one without
    a letter, is :data:`UNKNOWN` with score 0, and so is every text if nothing was learned.
    Ties go to the first language by name; nothing known of any word is such a tie.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    sent = shared(spark, model)
    kinds = [docs.schema[c] for c in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds)
    return docs.select(*keep, "text").mapInArrow(
        lambda batches: _predict(batches, sent(), len(keep)),
        f"{schema}, lang_pred string, score double",
    )


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every document; learns from the rows not held out.

    Null languages and texts teach nothing; a null or letterless text is :data:`UNKNOWN`.
    Repeated rows count as often as they are there. An empty table gives no rows, and a
    table without labelled rows outside the held-out ones gives :data:`UNKNOWN` throughout.
    """
    flagged = docs.withColumn("held_out", held_out("doc_id"))
    model = train(flagged.where("not held_out"))
    return predict(flagged, model, "doc_id", "held_out")


def keep_identified(docs: DataFrame, *, least_score: float = 0.5) -> DataFrame:
    """Rows of ``docs`` (all columns) whose text is in a learned language.

    Rejected are texts without letters and those no language of which reaches
    ``least_score``. Rows keep all their columns through the prediction.
    """
    flagged = docs.withColumn("__held_out", held_out("doc_id"))
    model = train(flagged.where("not __held_out"))
    named = docs.withColumn("__text", F.col("text"))
    columns = docs.columns
    renamed = named.select(*[F.col(c).alias(f"__{i}") for i, c in enumerate(columns)], F.col("__text").alias("text"))
    predicted = predict(renamed, model, *[f"__{i}" for i in range(len(columns))])
    kept = predicted.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score))
    return kept.select(*[F.col(f"__{i}").alias(c) for i, c in enumerate(columns)])
