"""Rows per range."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangeloom.functions.names import quoted
from rangeloom.plans.ranges import RangePlan

INDEX = "partition_index"


def with_partition(df: DataFrame, key: str, plan: RangePlan, keep_nulls: bool = False) -> DataFrame:
    """Keep the rows of the planned span and add their range index, in one scan.

    The span test is a plain comparison on the key, so it reaches the scan. NULL
    keys are dropped, or kept with a NULL index.
    """
    inside = plan.contains(key)
    if keep_nulls:
        inside = f"{inside} OR {quoted(key)} IS NULL"
    return df.where(inside).selectExpr("*", f"{plan.index_of(key)} AS {INDEX}")


def partition_counts(df: DataFrame, key: str, plan: RangePlan) -> DataFrame:
    """``(partition_index, lo, hi, expected_rows, rows_read)`` for every range of the plan.

    Rows are pre-aggregated before the one shuffle, so a range holding most of the
    data costs no more than the others. Empty ranges come from adding the plan's own
    rows with weight zero; no join is needed, as the bounds follow from the index.
    """
    seen = with_partition(df.select(quoted(key)), key, plan).selectExpr(INDEX, "1L AS n")
    planned = df.sparkSession.range(plan.n_partitions).selectExpr(f"id AS {INDEX}", "0L AS n")
    counted = seen.unionAll(planned).groupBy(INDEX).agg(F.sum("n").alias("rows_read"))
    return counted.selectExpr(INDEX, *plan.describe(), "rows_read")
