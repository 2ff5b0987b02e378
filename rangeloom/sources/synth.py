"""A ten-column table generated from its ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the generated table.
NOTE = "Sample notes"
USER_PREFIX = "user_"
LOGIN_DAYS = 365
START_DAYS = 1000

DECLARED_COLUMNS: tuple[tuple[str, str], ...] = (
    ("id", "Int64"),
    ("uuid", "Utf8"),
    ("username", "Utf8"),
    ("score", "Float32"),
    ("is_active", "Boolean"),
    ("last_login", "Timestamp(Nanosecond, None)"),
    ("notes", "Utf8"),
    ("course_id", "Int32"),
    ("start_date", "Date32"),
    ("rating", "Float64"),
)

# "Now" of the generated times, fixed so that a table can be generated again.
ANCHOR = "2025-01-01 00:00:00"


def series(spark: SparkSession, first: int, last: int, name: str = "id") -> DataFrame:
    """The integers from ``first`` to ``last``, both included."""
    return spark.range(first, last + 1).toDF(name)


def _share(key: Column, seed: int, stream: str) -> Column:
    """A number in [0, 1) that depends on the id, not on how rows are partitioned."""
    mixed = F.xxhash64(key, F.lit(seed), F.lit(stream))
    return F.pmod(mixed, F.lit(2**53)).cast("double") / F.lit(float(2**53))


def synth_columns(ids: DataFrame, key: str = "id", seed: int = 42) -> DataFrame:
    """Generate the table's rows for the given ids."""
    i = F.col(key).cast("long")
    anchor = F.expr(f"timestamp_ntz'{ANCHOR}'")

    def before(days: int, stream: str) -> Column:
        micros = F.floor(_share(i, seed, stream) * (days * 86_400_000_000))
        return F.timestamp_add("MICROSECOND", -micros, anchor)

    return ids.select(
        i.alias("id"),
        F.md5(i.cast("string")).alias("uuid"),
        F.concat(F.lit(USER_PREFIX), i.cast("string")).alias("username"),
        (_share(i, seed, "score") * 100).cast("float").alias("score"),
        (i % 2 == 0).alias("is_active"),
        before(LOGIN_DAYS, "last_login").alias("last_login"),
        F.when(i % 10 != 0, F.lit(NOTE)).alias("notes"),
        F.rint(_share(i, seed, "course_id") * 10 + 100).cast("int").alias("course_id"),
        before(START_DAYS, "start_date").cast("date").alias("start_date"),
        (_share(i, seed, "rating") * 5).alias("rating"),
    )


def synth_table(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """The table for ids ``1..n``."""
    return synth_columns(series(spark, 1, n), seed=seed)
