"""Range-partitioned reads of a query over JDBC.

Explicit predicates are used rather than ``partitionColumn``/``lowerBound``/
``upperBound``: those leave both ends open and put NULL keys in the first range,
so they would return rows outside the planned span.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession

from rangeloom.plans.ranges import RangePlan
from rangeloom.plans.spec import LoadSpec, jdbc_options

# Rows the driver fetches per round trip; JDBC drivers default to very few or all.
FETCH_SIZE = "10000"


def derived_table(select: str) -> str:
    """A SELECT as a derived table."""
    return f"({select}) AS sub"


def bounds_query(spec: LoadSpec, key: str) -> str:
    """The database computes the bounds; one row comes back."""
    return f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {derived_table(spec.select)}) AS bounds"


def _options(spec: LoadSpec) -> dict[str, str]:
    found = jdbc_options(spec.connection_string)
    return {"fetchsize": FETCH_SIZE, "preferTimestampNTZ": "true"} | found


def _reader(spark: SparkSession, spec: LoadSpec) -> DataFrameReader:
    return spark.read.format("jdbc").options(**_options(spec))


def jdbc_key_bounds(spark: SparkSession, spec: LoadSpec, key: str) -> tuple[int, int] | None:
    row = _reader(spark, spec).option("dbtable", bounds_query(spec, key)).load().first()
    lo, hi = row
    return None if lo is None else (int(lo), int(hi))


def jdbc_schema(spark: SparkSession, spec: LoadSpec) -> DataFrame:
    """The query with no plan: gives the columns, and the rows of an unkeyed source."""
    return _reader(spark, spec).option("dbtable", derived_table(spec.select)).load()


def read_one(spark: SparkSession, spec: LoadSpec, predicate: str) -> DataFrame:
    """One range of the query in one statement."""
    part = f"(SELECT * FROM {derived_table(spec.select)} WHERE {predicate}) AS part"
    return _reader(spark, spec).option("dbtable", part).load()


def split_predicates(predicate: str, split_by: str | None, splits: int) -> list[str]:
    """The predicate in ``splits`` parts by the remainder of a second integer, NULLs counting as zero."""
    if split_by is None:
        return [predicate]
    part = f"ABS(MOD(COALESCE({split_by}, 0), {splits}))"
    return [f"{predicate} AND {part} = {i}" for i in range(splits)]


def read_parts(
    spark: SparkSession, spec: LoadSpec, predicate: str, split_by: str | None = None, splits: int = 1
) -> DataFrame:
    """One range of the query, in one statement or in ``splits`` statements."""
    if split_by is None:
        return read_one(spark, spec, predicate)
    options = _options(spec)
    url = options.pop("url")
    predicates = split_predicates(predicate, split_by, splits)
    return spark.read.jdbc(url, derived_table(spec.select), predicates=predicates, properties=options)


def read_sample(spark: SparkSession, spec: LoadSpec, rows: int) -> DataFrame:
    """Any ``rows`` rows of the query; the database applies the limit."""
    sample = f"(SELECT * FROM {derived_table(spec.select)} LIMIT {rows}) AS sample"
    return _reader(spark, spec).option("dbtable", sample).load()


def read_ranges(
    spark: SparkSession,
    spec: LoadSpec,
    plan: RangePlan,
    key: str,
    max_connections: int,
    keep_nulls: bool = False,
    split_by: str | None = None,
    splits: int = 1,
) -> DataFrame:
    """One task and one connection per slice of the plan, at most ``max_connections``.

    ``split_by`` and ``splits`` divide the slices further, see
    :meth:`RangePlan.predicates`; the cap counts those parts too. Every slice is its own
    statement: there is no snapshot common to all of them.
    """
    options = _options(spec)
    url = options.pop("url")
    room = max_connections - splits if keep_nulls and max_connections > splits else max_connections
    return spark.read.jdbc(
        url,
        derived_table(spec.select),
        predicates=plan.predicates(key, room, keep_nulls, split_by, splits),
        properties=options,
    )
