"""Where loaded rows go: Arrow, pandas, tables, files of a fixed batch size."""

from __future__ import annotations

from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_ARROW = "spark.sql.execution.arrow.pyspark.enabled"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def to_arrow(df: DataFrame) -> pa.Table:
    """The whole result as one Arrow table on the driver: for bounded results only."""
    return df.toArrow()


def to_pandas(data: DataFrame | pa.Table) -> pd.DataFrame:
    """The whole result in pandas, moved as Arrow: for bounded results only."""
    if not isinstance(data, DataFrame):
        return data.to_pandas()
    with _setting(data.sparkSession, _ARROW, "true"):
        return data.toPandas()


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, format: str = "parquet", path: str | None = None
) -> None:
    """Drop the table if it exists and create it empty with the declared columns.

    With ``path`` its files are there, and stay when the table is dropped.
    """
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source=format, schema=schema)


def insert_select(df: DataFrame, table: str) -> None:
    """Append the rows to an existing table, by position."""
    df.write.insertInto(table)


def write_batches(df: DataFrame, path: str, batch_size: int, format: str = "parquet") -> None:
    """Write files of at most ``batch_size`` rows."""
    df.write.mode("overwrite").option("maxRecordsPerFile", batch_size).format(format).save(path)
