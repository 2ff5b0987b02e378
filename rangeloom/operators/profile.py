"""How many NULLs each column gets, and how many of them are failed decodes."""

from __future__ import annotations

import re
from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from rangeloom.functions.casts import sql_text
from rangeloom.functions.names import quoted
from rangeloom.operators.bind import rename_by_position, typed_columns
from rangeloom.plans.spec import LoadSpec, as_spec
from rangeloom.sources import jdbc
from rangeloom.sources.queries import key_bounds, query_as_source

_EMPTY_AUTHORITY = re.compile(r"^(\w+):///")

# Fixed value: rows looked at by a profile unless the caller says otherwise.
SAMPLE_ROWS = 10_000

# One task may sort this many rows per sampled row; beyond that the sort is staged.
ROWS_PER_FINAL_TASK = 20


def first_rows(df: DataFrame, key: str, n: int = SAMPLE_ROWS) -> DataFrame:
    """The ``n`` rows with the least keys, the same ones every time; rows with a NULL key come last.

    A plain sort-and-limit makes every task offer ``n`` rows to one last task. Here
    one pass over the key column alone first counts rows in windows ``[lo, lo+n)``,
    ``[lo, lo+2n)``, ... and the smallest window with ``n`` rows becomes a filter on
    the scan. If even that holds far more than ``n`` rows (one key repeated, say), the
    rows are first thinned to ``n`` in each of several groups.
    """
    bounds = key_bounds(df, key)
    if bounds is None:
        return df.limit(n)
    lo, hi = bounds
    value = F.col(quoted(key))
    # Rows that differ come in one order; maps have no hash.
    tie = F.xxhash64(*[F.col(quoted(f.name)) for f in df.schema.fields if "map<" not in f.dataType.simpleString()])
    edges = [hi]
    step = n
    while lo + step - 1 < hi:
        edges.append(lo + step - 1)
        step *= 2
    edges.sort()
    counts = df.selectExpr(*[f"count_if({quoted(key)} <= {edge}L)" for edge in edges]).first()
    edge, rows = next(((e, c) for e, c in zip(edges, counts) if c >= n), (edges[-1], counts[-1]))
    near = df.where(value <= F.lit(edge))
    if rows < n:
        return near.unionAll(df.where(value.isNull()).limit(n - rows))
    if rows == n:
        return near
    if rows > ROWS_PER_FINAL_TASK * n:
        groups = max(int((rows / n) ** 0.5), 2)
        group = F.pmod(F.spark_partition_id(), F.lit(groups))
        rank = F.row_number().over(Window.partitionBy("__group").orderBy(value, tie))
        near = (
            near.withColumn("__group", group)
            .withColumn("__rank", rank)
            .where(F.col("__rank") <= n)
            .drop("__group", "__rank")
        )
    return near.orderBy(value, tie).limit(n)


def first_rows_in_files(files: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """The first ``n`` rows of a plain scan of Parquet files, by file name and place.

    Rows per file come from the files' footers: of the first file, the next two, the next
    four, until there are enough. Only those files are read, nothing is sorted, and the
    same rows come every time. Files in folders named by column values are not taken.
    """
    plan = files._jdf.queryExecution().optimizedPlan()
    if plan.nodeName() != "LogicalRelation":
        raise ValueError("only a plain scan of files has first rows; choose columns afterwards")
    spark, names = files.sparkSession, sorted(files.inputFiles())
    path, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    scan = lambda some: spark.read.schema(files.schema).parquet(*map(unquote, some))
    taken, rows, last, at, step = [], 0, None, 0, 1
    while at < len(names) and rows < n:
        some = names[at : at + step]
        found = {r.path: r.n for r in scan(some).groupBy(path.alias("path")).agg(F.count("*").alias("n")).collect()}
        for name in some:
            if rows < n:
                known = _EMPTY_AUTHORITY.sub(r"\1:/", name)  # as the metadata writes it
                taken.append(name)
                last, rows = (known, n - rows), rows + found.get(known, 0)
        at, step = at + step, step * 2
    if not taken:
        return files.limit(0)
    return scan(taken) if rows <= n else scan(taken).where((path != last[0]) | (place < last[1]))


def _report(df: DataFrame, measures: dict[str, dict[str, str]]) -> DataFrame:
    """One aggregate over all columns, turned into one row per column."""
    names = list(measures)
    aggregates = ["count(*) AS rows"]
    for i, name in enumerate(names):
        aggregates += [f"{m} AS {label}_{i}" for label, m in measures[name].items()]
    lines = [
        f"struct({sql_text(name)} AS column_name, rows, "
        + ", ".join(f"{label}_{i} AS {label}" for label in measures[name])
        + ")"
        for i, name in enumerate(names)
    ]
    return df.selectExpr(*aggregates).selectExpr(f"inline(array({', '.join(lines)}))")


def null_profile(
    df: DataFrame, schema: T.StructType, key: str = "id", sample_rows: int | None = SAMPLE_ROWS
) -> DataFrame:
    """``(column_name, rows, null_count)`` of a safe decode.

    Looks at the first ``sample_rows`` rows by ``key`` (a source column), or at all rows if
    ``sample_rows`` is None, for instance those of :func:`first_rows_in_files`.
    """
    named = _sample(df, schema, key, sample_rows)
    typed = typed_columns(named, schema)
    return _report(named, {t.name: {"null_count": f"count_if({t.value} IS NULL)"} for t in typed})


def decode_profile(
    df: DataFrame, schema: T.StructType, key: str = "id", sample_rows: int | None = SAMPLE_ROWS
) -> DataFrame:
    """:func:`null_profile` with ``decode_failures``: the NULLs that were values at the source."""
    named = _sample(df, schema, key, sample_rows)
    measures = {
        t.name: {
            "null_count": f"count_if({t.value} IS NULL)",
            "decode_failures": f"count_if({t.failed or 'false'})",
        }
        for t in typed_columns(named, schema)
    }
    return _report(named, measures)


def profile_spec(
    spark: SparkSession,
    spec: LoadSpec | Mapping | str,
    key: str = "id",
    sample_rows: int = SAMPLE_ROWS,
) -> dict[str, int]:
    """NULLs per declared column in a safe decode of a spec's first rows.

    A database is asked for any ``sample_rows`` rows, in one statement.
    """
    spec = as_spec(spec)
    if spec.runs_on_session:
        report = null_profile(query_as_source(spark, spec.query), spec.schema, key, sample_rows)
    else:
        sample = jdbc.read_sample(spark, spec, sample_rows)
        report = null_profile(sample, spec.schema, sample_rows=None)
    return {line.column_name: line.null_count for line in report.collect()}


def _sample(df: DataFrame, schema: T.StructType, key: str, sample_rows: int | None) -> DataFrame:
    rows = df if sample_rows is None else first_rows(df, key, sample_rows)
    return rename_by_position(rows, schema)
