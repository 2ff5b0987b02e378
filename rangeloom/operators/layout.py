"""Writing a table so that later range reads touch only their own files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rangeloom.functions.skew import ROW_TAG, with_row_tag


def range_layout(df: DataFrame, key: str, n_files: int) -> DataFrame:
    """Split by key range into ``n_files`` partitions, each sorted by key.

    The ranges are cut on the key and a row tag, so the rows of one heavily repeated
    key are shared by several partitions instead of filling one.
    """
    tagged = with_row_tag(df)
    return (
        tagged.repartitionByRange(n_files, F.col(key), F.col(ROW_TAG))
        .sortWithinPartitions(key)
        .drop(ROW_TAG)
    )


def write_range_layout(
    df: DataFrame, path: str, key: str, n_files: int, rows_per_file: int | None = None
) -> None:
    """Write the layout as Parquet, whose min/max statistics then prune range reads."""
    writer = range_layout(df, key, n_files).write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def analyze_table(spark: SparkSession, table: str, columns: list[str] | None = None) -> None:
    """Table statistics, and column statistics for the given columns (default: all)."""
    what = f"FOR COLUMNS {', '.join(columns)}" if columns else "FOR ALL COLUMNS"
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS {what}")
