"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its shuffled documents. A document's virtual finish time is
the words of its source up to and with it, divided by the source's target; the mix is
the documents in the order of that time, cut at the total budget. A source whose target
is above its size queues its documents again, up to ``max_repeats`` times in all.

Sums run in ranges, never in one task: a source is cut into ranges of the shuffle key
(so a source with a third of all rows is many ranges), the time line into ranges of
finish time. Range totals are added up first; only the range with the cut is sorted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rangeloom.llm.common import write_once

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
#: Documents in a range of the shuffle key or of finish time.
RANGE_ROWS = 5_000
#: Rows up to which the table of sources is broadcast (about 60 bytes each).
BROADCAST_SOURCES = 100_000

_UNIT = ("doc_id", "source", "size")


def word_count(text: Column) -> Column:
    """Number of runs of anything but space and U+0009 to U+000D; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``(source, source_rank, source_size, n_units, target)`` from ``(source, size, copies)``.

    Sources in code point order, null last, have the weights in turn. Targets share the
    sum of all sizes by weight, but stop at ``max_repeats`` times the source's size; the
    excess goes to the others by weight. In order of size by weight, a source is at its
    stop if the level left by those before it is above its own. One row per source.
    """
    cycle = F.array(*[F.lit(w) for w in weights])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    sources = (
        sizes.groupBy("source")
        .agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.count("*").alias("n_units"))
        .withColumn("source_rank", F.row_number().over(by_name))
        .withColumn("weight", F.get(cycle, (F.col("source_rank") - 1) % len(weights)))
        .withColumn("stop", F.col("source_size") * max_repeats)
    )
    every = Window.partitionBy()
    before = Window.orderBy(F.col("stop") / F.col("weight"), "source_rank").rowsBetween(
        Window.unboundedPreceding, -1
    )
    total, weight = F.sum("source_size").over(every), F.sum("weight").over(every)
    level = (total - F.coalesce(F.sum("stop").over(before), F.lit(0))) / (
        weight - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    place = F.row_number().over(Window.orderBy(F.col("stop") / F.col("weight"), "source_rank"))
    levels = sources.withColumn("level", level).withColumn("place", place)
    levels = levels.withColumn("stopped", F.col("level") * F.col("weight") > F.col("stop"))
    free = F.min(F.when(~F.col("stopped"), F.struct("place", "level"))).over(every)["level"]
    target = F.when(F.col("stopped"), F.col("stop").cast("double")).otherwise(free * F.col("weight"))
    return levels.select(
        "source", "source_rank", "source_size", "n_units", F.coalesce(target, F.lit(0.0)).alias("target")
    )


def mix_plan(
    docs: DataFrame,
    *,
    weights=WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    seed: str = "mix",
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """How often the mix takes each document.

    Takes ``doc_id, source, text`` (others are not read) and returns one row per distinct
    ``(doc_id, source, size)``: these, ``copies`` (rows that share them: repeated rows are
    taken or left together), ``source_size``, ``target`` and ``times`` (0 to ``max_repeats``).

    A source queues no document once its words reach its target, so it never goes over by
    more than a document. The mix ends before the first document that would bring it over
    the sum of all sizes.
    A null text has size 0, a null source is a source, a null doc_id an id. An empty table
    gives no rows. The order within a source is the md5 of seed and id: reruns agree.
    """
    units = write_once(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
        .groupBy(*_UNIT)
        .agg(F.count("*").alias("copies"))
    )
    targets = write_once(source_targets(units, weights, max_repeats).coalesce(1))
    if targets.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    keyed = units.join(
        targets.withColumnRenamed("source", "source_"), F.col("source").eqNullSafe(F.col("source_"))
    ).drop("source_").withColumn("key", key)
    share = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / float(1 << 32)
    keyed = keyed.withColumn("part", F.floor(share * F.ceil(F.col("n_units") / range_rows)))
    # Words of the source up to and with the document: within its range, plus the ranges before.
    words = F.col("size") * F.col("copies")
    ranges = keyed.groupBy("source_rank", "part").agg(F.sum(words).alias("range_words"))
    ahead = Window.partitionBy("source_rank").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("ahead", F.coalesce(F.sum("range_words").over(ahead), F.lit(0)))
    within = (
        Window.partitionBy("source_rank", "part").orderBy("key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    queued = write_once(
        keyed.withColumn("upto", F.sum(words).over(within))
        .join(ranges.select("source_rank", "part", "ahead"), ["source_rank", "part"])
        .withColumn("upto", F.col("upto") + F.col("ahead"))
        .drop("part", "ahead", "n_units")
    )
    sums = queued.agg(F.sum(words).alias("total"), F.count("*").alias("n")).first()
    budget, n = sums["total"] or 0, sums["n"]

    def finish(turn: Column) -> Column:
        return F.coalesce(
            F.when(F.col("target") > 0, (turn * F.col("source_size") + F.col("upto")) / F.col("target")),
            F.lit(0.0),
        )

    def place(turn: Column) -> Column:
        return F.struct(finish(turn).alias("finish"), "source_rank", "key", "doc_id", "size")

    def wanted(turn: Column) -> Column:
        return turn * F.col("source_size") + F.col("upto") - words < F.col("target")

    turns = queued.withColumn(
        "turn", F.explode(F.array(*[F.lit(i) for i in range(max_repeats)]))
    ).where(wanted(F.col("turn"))).select(place(F.col("turn")).alias("place"), words.alias("words"))
    slots = max(1, math.ceil(max_repeats * n / range_rows))
    turns = turns.withColumn("slot", F.floor(F.col("place.finish") * slots))
    line = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    slot_sums = turns.groupBy("slot").agg(F.sum("words").alias("words"))
    over = (
        slot_sums.withColumn("upto", F.sum("words").over(line))
        .where(F.col("upto") > budget)
        .orderBy("slot")
        .select("slot", (F.col("upto") - F.col("words")).alias("ahead"))
        .first()
    )
    taken = wanted
    if over is not None:
        sorted_slot = Window.partitionBy("slot").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
        first_out = (
            turns.where(F.col("slot") == over["slot"])
            .withColumn("upto", F.sum("words").over(sorted_slot) + over["ahead"])
            .where(F.col("upto") > budget)
            .agg(F.min("place").alias("place"))
        )
        cut = first_out.first()["place"]
        limit = F.struct(
            F.lit(cut["finish"]).alias("finish"), F.lit(cut["source_rank"]).alias("source_rank"),
            F.lit(cut["key"]).alias("key"), F.lit(cut["doc_id"]).cast("long").alias("doc_id"),
            F.lit(cut["size"]).cast("long").alias("size"),
        )
        queued = queued.withColumn("doc_id", F.col("doc_id").cast("long"))
        taken = lambda turn: wanted(turn) & (place(turn) < limit)
    times = sum((F.when(taken(F.lit(i)), 1).otherwise(0) for i in range(max_repeats)), F.lit(0))
    return queued.select(*_UNIT, "copies", "source_size", "target", times.cast("int").alias("times"))


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as :func:`mix_plan` takes it.

    All columns are kept; texts of size 0 are kept once (they cost the budget nothing).
    """
    plan = mix_plan(docs, **options).select(*[F.col(c).alias(f"__{c}") for c in (*_UNIT, "times")])
    sized = docs.withColumn("__own_size", word_count(F.col("text")))
    same = (
        F.col("doc_id").eqNullSafe(F.col("__doc_id"))
        & F.col("source").eqNullSafe(F.col("__source"))
        & (F.col("__own_size") == F.col("__size"))
    )
    times = F.when(F.col("__size") == 0, 1).otherwise(F.col("__times"))
    return (
        sized.join(plan, same)
        .withColumn("__turn", F.explode(F.array_repeat(F.lit(1), times)))
        .select(*[sized[c] for c in docs.columns])
    )


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken`` (repeats counted)."""
    return (
        mix_plan(docs, **options)
        .withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
        .select(
            "doc_id", "size", "source_size", "target",
            (F.col("size") * F.col("times")).alias("taken"),
        )
    )
