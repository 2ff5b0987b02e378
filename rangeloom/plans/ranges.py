"""Equal-width range partitioning of an integral key.

A plan is four numbers, so it is held on the driver in constant space however
many ranges it has. Everything per range or per row is column arithmetic.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from rangeloom.functions.names import quoted

# Ranges per core and the least width an auto-tuned range may have.
RANGES_PER_CORE = 4
MIN_AUTO_WIDTH = 10_000

_LONG_MAX = 2**63 - 1
_EXACT = "decimal(20,0)"


def default_parallelism(spark: SparkSession) -> int:
    """Cores the session can use at once."""
    return spark.sparkContext.defaultParallelism


def autotune_width(span: int, parallelism: int, rows_per_partition: int = 0) -> int:
    """Keys per range: the caller's number if positive, else a share of the span."""
    if rows_per_partition > 0:
        return min(rows_per_partition, _LONG_MAX)
    return max(max(span, 1) // (parallelism * RANGES_PER_CORE), MIN_AUTO_WIDTH)


@dataclass(frozen=True)
class RangePlan:
    """Ranges ``[lo + i*width, min(lo + (i+1)*width - 1, hi)]`` for ``i`` from 0."""

    lo: int
    hi: int
    width: int

    def __post_init__(self) -> None:
        if self.hi < self.lo or self.width < 1:
            raise ValueError(f"not a range plan: {self}")
        if self.n_partitions > _LONG_MAX:
            raise ValueError(f"too many ranges: {self}")

    @property
    def span(self) -> int:
        return self.hi - self.lo + 1

    @property
    def n_partitions(self) -> int:
        return -(-self.span // self.width)

    @property
    def _wide(self) -> bool:
        # Key differences no longer fit a long: do the arithmetic in decimals.
        return self.span > _LONG_MAX

    def _number(self, sql: str) -> str:
        return f"CAST({sql} AS {_EXACT if self._wide else 'BIGINT'})"

    def _literal(self, value: int) -> str:
        return self._number(f"'{value}'") if abs(value) >= 2**31 or self._wide else f"{value}L"

    # Expressions are SQL text: one call to the JVM each, however long they are.

    def contains(self, key: str) -> str:
        """SQL test whether a key column lies in the planned span. NULL keys do not."""
        return f"{quoted(key)} BETWEEN CAST('{self.lo}' AS BIGINT) AND CAST('{self.hi}' AS BIGINT)"

    def index_of(self, key: str) -> str:
        """SQL for the index (a bigint) of the range that holds a key column's value."""
        return f"({self._number(quoted(key))} - {self._literal(self.lo)}) div {self._literal(self.width)}"

    def describe(self, index: str = "partition_index") -> list[str]:
        """SQL for the range columns, computed from the index alone.

        ``expected_rows`` is the width of the range: its row count if keys are dense
        and unique.
        """
        start = f"{self._number(quoted(index))} * {self._literal(self.width)}"
        lo = f"CAST({start} + {self._literal(self.lo)} AS BIGINT)"
        left = f"{self._literal(self.span)} - {start}"
        expected = f"CAST(least({left}, {self._literal(self.width)}) AS BIGINT)"
        return [f"{lo} AS lo", f"{lo} + ({expected} - 1L) AS hi", f"{expected} AS expected_rows"]

    def frame(self, spark: SparkSession) -> DataFrame:
        """The plan as rows ``(partition_index, lo, hi, expected_rows)``."""
        plan = spark.range(self.n_partitions).toDF("partition_index")
        return plan.selectExpr("partition_index", *self.describe())

    def slices(self, max_slices: int) -> list[tuple[int, int]]:
        """Inclusive key bounds of at most ``max_slices`` runs of whole ranges.

        Adjacent ranges are merged, so a run is a single ``BETWEEN`` and no key
        is left out however fine the plan is.
        """
        n = min(self.n_partitions, max(max_slices, 1))
        cuts = [self.lo + self.width * (self.n_partitions * i // n) for i in range(n)] + [self.hi + 1]
        return [(a, b - 1) for a, b in zip(cuts, cuts[1:])]

    def predicates(
        self,
        key: str,
        max_slices: int,
        keep_nulls: bool = False,
        split_by: str | None = None,
        splits: int = 1,
    ) -> list[str]:
        """One SQL predicate per slice; they are disjoint and cover the span.

        Key ranges cannot divide one heavily repeated key. ``split_by``, any integer
        expression of the database, does: each slice is read in ``splits`` parts by its
        remainder, NULLs counting as zero.
        """
        ranges = [f"{key} BETWEEN {a} AND {b}" for a, b in self.slices(max(max_slices // splits, 1))]
        if keep_nulls:
            ranges.append(f"{key} IS NULL")
        if split_by is None:
            return ranges
        part = f"ABS(MOD(COALESCE({split_by}, 0), {splits}))"
        return [f"{r} AND {part} = {i}" for r in ranges for i in range(splits)]


def tuned_frame(bounds: DataFrame, parallelism: int) -> DataFrame:
    """``(lo, hi, span, width, n_partitions)`` of an auto-tuned plan, from one row ``(lo, hi)``."""
    width = f"greatest(span div {parallelism * RANGES_PER_CORE}, {MIN_AUTO_WIDTH}L)"
    spans = bounds.where("lo IS NOT NULL").selectExpr("lo", "hi", "hi - lo + 1 AS span")
    return spans.selectExpr("*", f"{width} AS width").selectExpr("*", "(span + width - 1) div width AS n_partitions")


def make_plan(
    bounds: tuple[int, int] | None, parallelism: int, rows_per_partition: int = 0
) -> RangePlan | None:
    """Plan for the key bounds; None when the source has no keys."""
    if bounds is None:
        return None
    lo, hi = bounds
    return RangePlan(lo, hi, autotune_width(hi - lo + 1, parallelism, rows_per_partition))
