"""Sources that Spark reads itself: SQL text, tables, files; and their key bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rangeloom.functions.names import quoted
from rangeloom.plans.session import JOB_ERRORS
from rangeloom.plans.spec import inner_query

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def query_as_source(spark: SparkSession, query: str) -> DataFrame:
    """The result of a bare or enveloped SELECT, run on the session."""
    return spark.sql(inner_query(query))


def full_scan(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """The whole table in one unpartitioned read (Spark still splits the files)."""
    return spark.read.format(format).load(path)


def key_position(schema: T.StructType, key: str) -> int:
    """Position of the key column; it must exist once and be integral."""
    found = [i for i, f in enumerate(schema.fields) if f.name.lower() == key.lower()]
    if len(found) != 1:
        raise ValueError(f"the source needs exactly one column '{key}', it has {len(found)}")
    if not isinstance(schema.fields[found[0]].dataType, _INTEGRAL):
        raise ValueError(f"the partition key '{key}' is not an integer column")
    return found[0]


def bounds_frame(df: DataFrame, key: str) -> DataFrame:
    """One row ``(lo, hi)``; NULL keys do not count."""
    value = f"CAST({quoted(key)} AS BIGINT)"
    return df.selectExpr(f"min({value}) AS lo", f"max({value}) AS hi")


def key_bounds(df: DataFrame, key: str) -> tuple[int, int] | None:
    """Least and greatest key, or None if there is none. Reads the key column only."""
    row = bounds_frame(df, key).first()
    return None if row.lo is None else (row.lo, row.hi)


def footer_frame(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet files whose plain minima and maxima are answered by the footers.

    Aggregates are pushed to the footers only by the newer file source, which is switched
    on in a session of its own, with the caller's settings, so that the caller's stays as it is.
    """
    aside = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if aside.conf.isModifiable(key) and aside.conf.get(key, None) != value:
            aside.conf.set(key, value)
    older = aside.conf.get("spark.sql.sources.useV1SourceList")
    newer = ",".join(name for name in older.split(",") if name.strip() != "parquet")
    aside.conf.set("spark.sql.sources.useV1SourceList", newer)
    aside.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    reader = aside.read.schema(schema) if schema else aside.read
    return reader.parquet(path)


def parquet_key_bounds(
    spark: SparkSession, path: str, key: str, schema: T.StructType | None = None
) -> tuple[int, int] | None:
    """:func:`key_bounds` of Parquet files from their footers alone.

    Files without usable statistics fall back on reading the key column.
    """
    files = footer_frame(spark, path, schema)
    name = quoted(files.columns[key_position(files.schema, key)])
    try:
        # No cast around the key: it would keep the aggregate from the footers.
        lo, hi = files.agg(F.min(name), F.max(name)).first()
    except JOB_ERRORS:
        return key_bounds(spark.read.parquet(path), key)
    return None if lo is None else (lo, hi)

