"""Ranges of a key that hold about equally many rows, instead of equally many keys.

The cuts are quantiles of the key by a mergeable sketch, so finding them is one pass with a
small aggregate per task. A key that holds a whole range's rows or more is a range of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rangeloom.functions.names import quoted
from rangeloom.plans.ranges import RANGES_PER_CORE

#: Ranks of the sketch are right within this share of a range.
RANK_ERROR = 0.02
#: Ranges of a plan at most; the driver and the queries hold two numbers for each.
MAX_RANGES = 4_000


@dataclass(frozen=True)
class RowPlan:
    """Disjoint ranges, ascending, that cover all keys from the least to the greatest; ``rows`` in all."""

    ranges: tuple[tuple[int, int], ...]
    rows: int

    @property
    def n_partitions(self) -> int:
        return len(self.ranges)

    def predicates(self, key: str, keep_nulls: bool = False) -> list[str]:
        """One SQL predicate per range, for a database or a scan."""
        return [f"{key} BETWEEN {a} AND {b}" for a, b in self.ranges] + [f"{key} IS NULL"] * keep_nulls

    def index_of(self, key: str) -> str:
        """SQL for the index of the range that holds a key column's value, by halving the list of ranges."""
        value = f"CAST({quoted(key)} AS BIGINT)"
        starts = "array(" + ", ".join(f"CAST('{a}' AS BIGINT)" for a, _ in self.ranges) + ")"
        middle = "(s.a + s.b) div 2"
        step = f"IF(s.b - s.a <= 1L, s, IF({starts}[CAST({middle} AS INT)] <= {value}, struct({middle} AS a, s.b AS b), struct(s.a AS a, {middle} AS b)))"
        steps = f"sequence(1, {max(1, len(self.ranges).bit_length())})"
        found = f"aggregate({steps}, struct(0L AS a, {len(self.ranges)}L AS b), (s, i) -> {step}, s -> s.a)"
        low, high = self.ranges[0][0], self.ranges[-1][1]
        return f"CASE WHEN {value} BETWEEN CAST('{low}' AS BIGINT) AND CAST('{high}' AS BIGINT) THEN {found} END"

    def frame(self, spark: SparkSession) -> DataFrame:
        """The plan as rows ``(partition_index, lo, hi)``."""
        lines = [(i, a, b) for i, (a, b) in enumerate(self.ranges)]
        return spark.createDataFrame(lines, "partition_index bigint, lo bigint, hi bigint")


def make_row_plan(df: DataFrame, key: str, parallelism: int, rows_per_range: int = 0) -> RowPlan | None:
    """Ranges of about ``rows_per_range`` rows (0: four ranges a core); None without keys.

    A range is within :data:`RANK_ERROR` of an equal share at either end, unless keys that
    repeat a lot leave no place to cut there.
    """
    value = F.col(quoted(key)).cast("long")
    rows, lo, hi = df.agg(F.count(value), F.min(value), F.max(value)).first()
    if not rows:
        return None
    wanted = -(-rows // rows_per_range) if rows_per_range > 0 else parallelism * RANGES_PER_CORE
    n = max(1, min(wanted, MAX_RANGES, rows))
    if n == 1:
        return RowPlan(((lo, hi),), rows)
    shares = [k / n for k in range(1, n)]
    accuracy = min(int(n / RANK_ERROR) + 1, 2**31 - 1)
    cuts = df.agg(F.percentile_approx(value, shares, accuracy).alias("cuts")).first().cuts
    # A range ends with its cut; one that is cut at twice or more is a range alone.
    ranges, start = [], lo
    for cut in sorted(set(cuts)):
        if cuts.count(cut) > 1:
            if cut > start:
                ranges.append((start, cut - 1))
            ranges.append((cut, cut))
        else:
            if cut < start:
                continue
            ranges.append((start, cut))
        start = cut + 1
    if start <= hi:
        ranges.append((start, hi))
    return RowPlan(tuple(ranges), rows)


def row_counts(df: DataFrame, key: str, plan: RowPlan) -> DataFrame:
    """``(partition_index, lo, hi, rows_read)`` of every range of the plan, by one pre-aggregated pass."""
    placed = df.selectExpr(f"{plan.index_of(key)} AS partition_index").where("partition_index IS NOT NULL")
    counted = placed.groupBy("partition_index").agg(F.count("*").alias("rows_read"))
    planned = plan.frame(df.sparkSession).join(counted, "partition_index", "left")
    return planned.withColumn("rows_read", F.coalesce("rows_read", F.lit(0).cast("long")))
