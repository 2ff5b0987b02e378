"""Timing a load phase by phase."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Observation
from pyspark.sql import functions as F

from rangeloom.operators.load import Loaded


@dataclass(frozen=True)
class LoadReport:
    """Declared columns, rows that passed, and seconds per phase."""

    columns: list[str]
    rows: int
    n_partitions: int
    setup_sec: float
    execute_sec: float

    @property
    def total_sec(self) -> float:
        return self.setup_sec + self.execute_sec

    def __str__(self) -> str:
        return (
            f"columns (in order): {', '.join(self.columns)}\n"
            f"rows: {self.rows:,} in {self.n_partitions:,} ranges\n"
            f"setup:   {self.setup_sec:.2f} s\n"
            f"execute: {self.execute_sec:.2f} s\n"
            f"total:   {self.total_sec:.2f} s"
        )


def timed_load(make: Callable[[], Loaded]) -> LoadReport:
    """Run a load to its end without keeping the rows.

    Setup covers bounds, plan and verdict; execute reads and decodes every row.
    Rows are counted on the way by an observation, not by a second pass.
    """
    start = time.perf_counter()
    loaded = make()
    ready = time.perf_counter()
    seen = Observation()
    loaded.rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode(
        "overwrite"
    ).save()
    done = time.perf_counter()
    return LoadReport(
        columns=loaded.rows.columns,
        rows=seen.get["rows"],
        n_partitions=loaded.plan.n_partitions if loaded.plan else 0,
        setup_sec=ready - start,
        execute_sec=done - ready,
    )
