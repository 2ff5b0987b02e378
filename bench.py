"""Time the headline queries and print one JSON line.

Environment: ``BENCH_SF_DIR`` (table folder), ``BENCH_CPUS`` (cores), ``BENCH_RUNS``,
``BENCH_SYNTH_ROWS`` (rows of the generated ten-column table).
Every query is run once to warm up; the best of the following runs counts. Rows are
fully produced (``noop`` sink), none are kept.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from rangeloom.functions.types import struct_of
from rangeloom.operators.load import load_parquet
from rangeloom.plans.session import load_session
from rangeloom.queries import QUERIES
from rangeloom.sources.dump import decode_files, write_dumps
from rangeloom.sources.synth import DECLARED_COLUMNS, synth_table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
SYNTH_ROWS = int(os.environ.get("BENCH_SYNTH_ROWS", "1000000"))

LINEITEM = struct_of([
    ("l_orderkey", "Int64"), ("l_partkey", "Int64"), ("l_suppkey", "Int64"),
    ("l_linenumber", "Int32"), ("l_quantity", "Float64"), ("l_extendedprice", "Float64"),
    ("l_discount", "Float64"), ("l_tax", "Float64"), ("l_returnflag", "Utf8"),
    ("l_linestatus", "Utf8"), ("l_shipdate", "Timestamp(Nanosecond, None)"),
])
TEN_COLUMNS = struct_of(DECLARED_COLUMNS)


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run) -> float:
    run()
    best = float("inf")
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        best = min(best, time.perf_counter() - start)
    return round(best, 4)


def loads(spark: SparkSession) -> tuple[dict, dict]:
    """Loads of lineitem and of the generated ten-column table, and their rates."""
    path = f"{SF_DIR}/lineitem.parquet"

    def load(**options) -> None:
        drain(load_parquet(spark, path, LINEITEM, LINEITEM.names, key="l_orderkey", **options).rows)

    times = {
        "load_lineitem": timed(load),
        "load_lineitem_indexed": timed(lambda: load(with_index=True)),
        "load_lineitem_ordered": timed(lambda: load(ordered=True)),
        "load_lineitem_null_partition": timed(lambda: load(on_error="null_partition")),
        "full_scan_lineitem": timed(lambda: drain(spark.read.parquet(path))),
    }

    # The ten-column table, once as Parquet and once as dump files.
    folder = tempfile.mkdtemp(prefix="bench-")
    synth_table(spark, SYNTH_ROWS).repartition(2 * int(CPUS)).write.parquet(f"{folder}/parquet")
    ten = spark.read.parquet(f"{folder}/parquet")
    assert write_dumps(ten, f"{folder}/dumps", TEN_COLUMNS) == SYNTH_ROWS

    def decode(split_bytes: int | None) -> None:
        drain(decode_files(spark, f"{folder}/dumps", TEN_COLUMNS, split_bytes=split_bytes))

    times["load_ten_columns"] = timed(
        lambda: drain(load_parquet(spark, f"{folder}/parquet", TEN_COLUMNS).rows)
    )
    times["single_stream_ten_columns"] = timed(lambda: drain(ten.coalesce(1)))
    times["decode_dump_files"] = timed(lambda: decode(None))
    times["decode_dump_splits"] = timed(lambda: decode(32 << 20))
    rates = {
        "ten_column_rows": SYNTH_ROWS,
        "load_rows_per_sec": round(SYNTH_ROWS / times["load_ten_columns"]),
        "decode_rows_per_sec": round(SYNTH_ROWS / times["decode_dump_files"]),
        "load_vs_single_stream": round(
            times["single_stream_ten_columns"] / times["load_ten_columns"], 2
        ),
    }
    return times, rates


def main() -> None:
    spark = load_session(
        "rangeloom-bench",
        spark__master=f"local[{CPUS}]",
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=CPUS,
    )
    spark.sparkContext.setLogLevel("ERROR")
    times, rates = loads(spark)
    for name, query in QUERIES.items():
        times[name] = timed(lambda query=query: drain(query(spark, SF_DIR)))
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rates": rates,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
