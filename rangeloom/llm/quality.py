"""Quality classifier by co-training of two views.

One classifier sees a document's text, the other its metadata (language, source, size).
Both start from the labelled rows; in each round either one labels the rows of the whole
unlabelled corpus it is surest of, for the other to learn from. Their outputs are calibrated
on labelled rows that neither learned from and combined as independent evidence.

Every text is turned into its features once, whole, and these are written. A round is a
pass over them in Spark that gives the few surest rows; only features come to the driver, of
those rows and of a bounded sample of labelled ones (``labelled_rows``, by a hash of the id).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from rangeloom.llm.common import Words, bound_batches, fold_table, shared, texts_of, write_once

#: Labelled rows that the classifiers are fitted on: about so many, twice as many at most.
LABELLED_ROWS = 4_000
#: Rounds, and rows that each classifier labels in a round, per class in proportion.
ROUNDS = 5
LABELS_PER_ROUND = 200
#: Share of labelled rows kept for calibration.
CALIBRATION = 0.25
#: Dimensions of hashed words, sources and languages.
WORD_DIMS, SOURCE_DIMS, LANG_DIMS = 256, 64, 16
RIDGE = 1.0

_FOLD = fold_table(lambda c: not (c == 0x20 or 0x09 <= c <= 0x0D), lower=True)
_CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "space": (9, 10, 11, 12, 13, 32),
    "stop": tuple(b".,;:?'\"-()"), "sign": tuple(b"!#$%&*+/<=>@[\\]^_`{|}~"), "line": (10,), "high": range(128, 256),
}
_CLASS_ROWS = np.array([[b in members for b in range(256)] for members in _CLASSES.values()], np.float64)


def text_features(texts: list[bytes]) -> np.ndarray:
    """Per text: character classes, word statistics and hashed words, all from the whole text."""
    words = Words(texts, _FOLD)
    out = np.zeros((len(texts), len(_CLASSES) + 5 + WORD_DIMS), np.float32)
    for k, text in enumerate(texts):
        if not text:
            continue
        counts = _CLASS_ROWS @ np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        own = words.hashes[words.of(k)]
        row = out[k]
        row[: len(_CLASSES)] = np.sqrt(counts / len(text))
        at = len(_CLASSES)
        lines = text.split(b"\n")
        n = max(1, len(own))
        row[at : at + 5] = (
            np.log1p(len(own)), len(text) / n / 10, len(np.unique(own)) / n, len(set(lines)) / len(lines), 1.0
        )
        hashed = np.bincount((own % np.uint64(WORD_DIMS)).astype(np.int64), minlength=WORD_DIMS)
        row[at + 5 :] = np.sqrt(hashed / n)
    return out


def metadata_features(langs: list, sources: list, sizes: list) -> np.ndarray:
    """Per row: hashed language and source and its size; nulls are values of their own."""
    out = np.zeros((len(langs), LANG_DIMS + SOURCE_DIMS + 3), np.float32)
    for k, (lang, source, size) in enumerate(zip(langs, sources, sizes, strict=True)):
        out[k, zlib.crc32(repr(lang).encode()) % LANG_DIMS] = 1
        out[k, LANG_DIMS + zlib.crc32(repr(source).encode()) % SOURCE_DIMS] = 1
        out[k, -3:] = np.log1p(max(0, size or 0)) / 10, size is None, 1
    return out


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic regression, by Newton steps."""
    x = x.astype(np.float64)
    weights = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        curve = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x.T * curve) @ x + RIDGE * np.eye(len(weights)), x.T @ (y - p) - RIDGE * weights)
        weights += step
        if np.abs(step).max() < 1e-6:
            break
    return weights


@dataclass
class CoTrained:
    """Two views' weights, their calibration (slope, offset) and the log odds of a good document."""

    text: np.ndarray
    metadata: np.ndarray
    calibration: tuple[np.ndarray, np.ndarray]
    prior: float

    def logits(self, text: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        views = (text @ self.text, metadata @ self.metadata)
        return tuple(c[0] * v + c[1] for v, c in zip(views, self.calibration, strict=True))


TEXT_SIZE, META_SIZE = len(_CLASSES) + 5 + WORD_DIMS, LANG_DIMS + SOURCE_DIMS + 3


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The features of both views, as half-precision bytes."""
    for batch in batches:
        text = text_features(texts_of(batch.column(1))).astype(np.float16)
        metadata = metadata_features(*(batch.column(i).to_pylist() for i in (2, 3, 4))).astype(np.float16)
        views = [pa.array([row.tobytes() for row in v], pa.binary()) for v in (text, metadata)]
        yield pa.record_batch([batch.column(0), *views], names=["doc_id", "text", "metadata"])


def _matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.float16).reshape(-1, size).astype(np.float32)


def _views(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return _matrix(table.column("text"), TEXT_SIZE), _matrix(table.column("metadata"), META_SIZE)


def features(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``row, doc_id, text, metadata, named`` of every document: a number, both views' features, whether ``labels`` name it.

    Written once. The features are shuffled here, whatever the size of ``labels``, and in no round again.
    """
    columns = [F.col("doc_id").cast("long"), "text", "lang", "source", F.col("n_chars").cast("long")]
    found = docs.select(*columns).mapInArrow(_describe, "doc_id bigint, text binary, metadata binary")
    numbered = found.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "text", "metadata")
    named = labels.select("doc_id").where("doc_id is not null").distinct().withColumn("named", F.lit(True))
    marked = numbered.join(named.hint("merge"), "doc_id", "left").withColumn("named", F.coalesce("named", F.lit(False)))
    return write_once(marked.select("row", "doc_id", "text", "metadata", "named"), large=True)


def _extremes(batches: Iterator[pa.RecordBatch], weights: list[np.ndarray], taken: list[np.ndarray], keep: int) -> Iterator[pa.RecordBatch]:
    """A task's rows of the lowest and highest logits of each view, less what the other was taught already."""
    best: list[list[tuple]] = [[], []]
    for batch in batches:
        row = batch.column("row").to_numpy()
        for k, x in enumerate(_views(batch)):
            logits = x.astype(np.float64) @ weights[k]
            free = np.flatnonzero(~np.isin(row, taken[1 - k]))
            order = free[np.lexsort((row[free], logits[free]))]
            ends = np.unique(np.concatenate([order[:keep], order[-keep:]]))
            best[k] += zip(logits[ends].tolist(), row[ends].tolist(), strict=True)
            best[k].sort()
            if len(best[k]) > 2 * keep:
                best[k] = best[k][:keep] + best[k][-keep:]
    for k in (0, 1):
        logits, rows = zip(*best[k], strict=True) if best[k] else ((), ())
        yield pa.record_batch(
            [pa.array([k] * len(rows), pa.int32()), pa.array(logits, pa.float64()), pa.array(rows, pa.int64())],
            names=["view", "logit", "row"],
        )


def _surest(pool: DataFrame, weights: list[np.ndarray], taken: list[np.ndarray], share: float) -> list[dict[int, float]]:
    """For each view, the rows of the pool that it is surest of and their labels, by the share of good rows."""
    good = max(1, round(LABELS_PER_ROUND * share))
    bad = max(1, LABELS_PER_ROUND - good)
    ends = pool.mapInArrow(lambda b: _extremes(b, weights, taken, LABELS_PER_ROUND), "view int, logit double, row bigint")
    low = F.row_number().over(Window.partitionBy("view").orderBy("logit", "row"))
    high = F.row_number().over(Window.partitionBy("view").orderBy(F.col("logit").desc(), F.col("row").desc()))
    ranked = ends.withColumn("low", low).withColumn("high", high)
    found = ranked.where(f"low <= {bad} AND logit < 0 OR high <= {good} AND logit > 0").collect()
    return [{r["row"]: float(r["logit"] > 0) for r in found if r["view"] == k} for k in (0, 1)]


def co_train(described: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS) -> CoTrained:
    """Fit both views on labelled rows and on what the other is sure of among all the others."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = described.join(_sample(known, labelled_rows), "doc_id").orderBy("doc_id", "row").toArrow()
    pool = described.where("not named").select("row", "doc_id", "text", "metadata")
    labelled, y = _views(rows), np.array([float(q > 0) for q in rows.column("quality").to_pylist()])
    aside = np.zeros(len(y), bool)
    if len(y) >= 20:
        aside[:: round(1 / CALIBRATION)] = True
    own = [(v[~aside], y[~aside]) for v in labelled]
    share = float(y.mean()) if len(y) else 0.5
    prior = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    weights = [fit(*o) for o in own]
    taken = [np.empty(0, np.int64) for _ in own]  # rows that each view has learned
    for _ in range(ROUNDS if len(y) else 0):
        taught = _surest(pool, weights, taken, share)
        wanted = sorted({r for of in taught for r in of})
        if not wanted:
            break
        # At most twice LABELS_PER_ROUND rows, by their numbers.
        found = described.where(F.col("row").isin(wanted)).orderBy("row").toArrow()
        at, views = {r: i for i, r in enumerate(found.column("row").to_pylist())}, _views(found)
        for k, of in enumerate(taught):
            other, rows_of = 1 - k, sorted(of)
            x, labels_of = views[other][[at[r] for r in rows_of]], np.array([of[r] for r in rows_of])
            own[other] = (np.concatenate([own[other][0], x]), np.concatenate([own[other][1], labels_of]))
            taken[other] = np.concatenate([taken[other], np.array(rows_of, np.int64)])
        weights = [fit(*o) for o in own]
    kept = aside if aside.any() else ~aside
    calibration = []
    for v, w in zip(labelled, weights, strict=True):
        score = np.stack([v[kept] @ w, np.ones(int(kept.sum()))], axis=1)
        calibration.append(fit(score, y[kept]))
    return CoTrained(weights[0], weights[1], tuple(calibration), prior)


def _sample(df: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` rows chosen by a hash of the id, twice as many at most."""
    one_in = max(1, df.count() // rows)
    return df.where(F.pmod(F.xxhash64("doc_id"), F.lit(one_in)) == 0).limit(2 * rows)


def _score(batches: Iterator[pa.RecordBatch], model: CoTrained) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = model.logits(*_views(batch))
        views = [1 / (1 + np.exp(-np.clip(v, -30, 30))) for v in (a, b, a + b - model.prior)]
        yield pa.record_batch(
            [batch.column("doc_id"), *[pa.array(v.astype(np.float64)) for v in views]],
            names=["doc_id", "text_score", "metadata_score", "score"],
        )


def score_quality(docs: DataFrame, labels: DataFrame, *, labelled_rows: int = LABELLED_ROWS) -> DataFrame:
    """``doc_id, text_score, metadata_score, score`` (0 to 1) of every row of ``docs``.

    Reads ``doc_id, text, lang, source, n_chars`` and ``doc_id, quality`` of ``labels``.
    Nulls and empty texts are features like others, and such rows are scored. Labels that
    are null or name no document teach nothing; of several labels of a document the highest
    counts, once; without any, all scores are even odds. Rows that share an id are scored
    each by itself. An empty table gives no rows.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    described = features(docs, labels)
    model = shared(spark, co_train(described, labels, labelled_rows))
    return described.select("row", "doc_id", "text", "metadata").mapInArrow(
        lambda batches: _score(batches, model()),
        "doc_id bigint, text_score double, metadata_score double, score double",
    )
