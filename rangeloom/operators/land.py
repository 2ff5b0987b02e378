"""Landing a load slice by slice, so that a lost source costs only its ranges.

A source that fails in mid-read (a dropped connection, a damaged file) fails its
Spark job. Here every slice of the plan is a job of its own that writes to a shared
folder: a query on the session is one slice, in one scan, a database is many. Values that
do not fit fail no job; they are marked, as in healing. A slice that cannot be read, after
Spark's own retries, is cut in halves until the ranges that fail are left alone.

What happened is a log: one line per slice that was landed or range that cannot be read,
with its bounds, rows and error, written under another name and then renamed. A line is
never changed. Only slices in the log are read, so a job that died leaves nothing behind,
and a load that is started again goes on with the ranges that the log does not have. From
the log alone, rows and failures come back without a look at the source
(:func:`read_landing`). It is in a folder named by all that decides the rows, so a changed
query, type or range width never meets older slices.
"""

from __future__ import annotations

import hashlib
import json
import logging
import threading
import time
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from rangeloom.functions.names import quoted
from rangeloom.functions.skew import ROW_TAG, with_row_tag
from rangeloom.operators import heal
from rangeloom.operators.bind import rename_by_position
from rangeloom.operators.counts import INDEX
from rangeloom.operators.load import NO_KEYS, Loaded, LoadOptions, empty_result
from rangeloom.plans.ranges import RangePlan, default_parallelism, make_plan
from rangeloom.plans.session import JOB_ERRORS, cause_of, cut_lineage
from rangeloom.plans.spec import LoadSpec, as_spec, jdbc_options
from rangeloom.sources import jdbc, queries
from rangeloom.sources.store import append_file, exists, qualified

log = logging.getLogger(__name__)

# Slices (= jobs) of a load from a database at most; finer plans land in runs of adjacent
# ranges. A query on the session is one slice: N of them would be N scans.
MAX_SLICES = 2_000

# What becomes of a range that the safe policy cannot read at all.
UNREADABLE = ("fail", "null_rows")

PIECE = "__piece"
_LINE = (
    "lo bigint, hi bigint, piece string, rows bigint, n_bad bigint, n_null_keys bigint, error string, began double, ended double"
)
LANDED, UNREAD = "error IS NULL", "error IS NOT NULL"


@dataclass
class Landing:
    """One load into one folder. ``read(lo, hi)`` gives a key range, ``read_nulls`` the NULL keys."""

    spark: SparkSession
    read: Callable[[int, int], DataFrame]
    plan: RangePlan
    schema: T.StructType
    directory: str
    options: LoadOptions
    label: str = ""
    read_nulls: Callable[[], DataFrame] | None = None
    max_failed: int | None = None
    unreadable: str = "fail"
    key: str | None = None  # its declared name, once something was read
    n_unread: int = 0
    settled: list | None = None  # landed lines, once nothing is landed any more
    lock: threading.Lock = field(default_factory=threading.Lock)

    def __post_init__(self) -> None:
        if self.unreadable not in UNREADABLE:
            raise ValueError(f"unreadable must be one of {UNREADABLE}")
        options = self.options
        parts = [self.label, self.schema.json(), options.key, options.check_utf8, options.rule, self.plan.lo, self.plan.width]
        self.manifest = json.dumps(parts)
        name = hashlib.sha256(self.manifest.encode()).hexdigest()[:16]
        self.root = f"{qualified(self.spark, self.directory).rstrip('/')}/load-{name}"

    # -- the log

    def commit(self, lo: int | None, hi: int | None, **found) -> None:
        line = {"lo": lo, "hi": hi, **found}
        append_file(self.spark, f"{self.root}/log/{uuid.uuid4().hex}.json", json.dumps(line))

    def landed_spans(self) -> list[tuple[int | None, int | None]]:
        """Key bounds of the landed slices, in order; one line per slice, held by the driver."""
        if not exists(self.spark, f"{self.root}/log"):
            return []
        lines = read_log(self.spark, self.root).where(LANDED).select("lo", "hi").distinct()
        return sorted(((r.lo, r.hi) for r in lines.collect()), key=lambda s: (s[0] is not None, s))

    # -- slices

    def bounds(self, first: int, last: int) -> tuple[int, int]:
        """Keys of the ranges ``first`` to ``last``."""
        lo = self.plan.lo + first * self.plan.width
        return lo, min(self.plan.lo + (last + 1) * self.plan.width - 1, self.plan.hi)

    def pending(self) -> Iterator[tuple[int, int]]:
        """Runs of ranges that no landed slice covers."""
        at = 0
        for lo, hi in self.landed_spans():
            if lo is None or not _covers(self.plan, lo, hi):
                continue
            first, last = (lo - self.plan.lo) // self.plan.width, (hi - self.plan.lo) // self.plan.width
            if first > at:
                yield at, first - 1
            at = max(at, last + 1)
        if at < self.plan.n_partitions:
            yield at, self.plan.n_partitions - 1

    def slices(self, max_slices: int) -> list[tuple[int, int]]:
        runs = list(self.pending())
        size = -(-sum(b - a + 1 for a, b in runs) // max_slices) if runs else 1
        return [(k, min(k + size - 1, b)) for a, b in runs for k in range(a, b + 1, size)]

    def write(self, read: Callable[[], DataFrame], lo: int | None, hi: int | None) -> str | None:
        """Land what is read and commit it; None, or why it cannot be read."""
        piece, began = uuid.uuid4().hex, time.time()
        try:
            source = read()
            self.key = key = self.schema.names[queries.key_position(source.schema, self.options.key)]
            index = f"{self.plan.index_of(key)} AS {INDEX}"  # NULL for a NULL key
            named = rename_by_position(source, self.schema).selectExpr("*", index)
            rows = heal.flagged(named, self.schema, key, self.options.rule, self.options.check_utf8)
            seen = heal.write_flagged(rows, f"{self.root}/{PIECE}={piece}")
        except JOB_ERRORS as error:
            return cause_of(error)
        times = {"began": began, "ended": time.time()}
        self.commit(lo, hi, piece=piece, rows=seen.rows, n_bad=seen.n_bad, n_null_keys=seen.n_null_keys, **times)
        if seen.n_bad and self.options.on_error == "fail":
            raise RuntimeError(f"keys {lo} to {hi}: {self.report().first().first_error}")
        return None

    def give_up(self, lo: int, hi: int, error: str) -> None:
        """A range that cannot be read: the end of the load, or a line of the log."""
        log.warning("keys %d to %d cannot be read: %s", lo, hi, error)
        if self.options.on_error == "safe" and self.unreadable == "fail":
            raise RuntimeError(f"keys {lo} to {hi} cannot be read, so not value by value either: {error}")
        with self.lock:
            self.n_unread += 1
            if self.max_failed is not None and self.n_unread > self.max_failed:
                raise RuntimeError(f"more than {self.max_failed} ranges cannot be read, the last one: {error}")
        self.commit(lo, hi, error=error)

    def land(self, first: int, last: int) -> None:
        lo, hi = self.bounds(first, last)
        error = self.write(lambda: self.read(lo, hi), lo, hi)
        if error is None:
            return
        if self.options.on_error == "fail":
            raise RuntimeError(f"keys {lo} to {hi} cannot be read: {error}")
        if first == last:
            self.give_up(lo, hi, error)
            return
        log.warning("keys %d to %d are cut in halves: %s", lo, hi, error)
        middle = (first + last) // 2
        self.land(first, middle)
        self.land(middle + 1, last)

    def land_nulls(self) -> None:
        """The NULL keys; nobody knows how many rows they would be, so they must be read."""
        if any(lo is None for lo, _ in self.landed_spans()):
            return
        error = self.write(self.read_nulls, None, None)
        if error is not None:
            raise RuntimeError(f"the rows with a NULL key cannot be read: {error}")

    # -- results

    def lines(self) -> DataFrame:
        """The lines of the log that count for this plan, one per slice."""
        found = read_log(self.spark, self.root)
        if self.plan is NO_KEYS:
            return found.where("lo IS NULL")
        whole = _aligned(self.plan)
        nulls = "lo IS NULL" if self.options.null_keys == "keep" else "false"
        return found.where(f"CASE WHEN lo IS NULL THEN {nulls} ELSE {whole} END")

    def pieces(self) -> list[tuple[str, int | None, int]]:
        """What to read: piece, its first key that counts (None: all), rows with a NULL key.

        Slices of drivers that ran at once may overlap; the later one counts from where the
        other ends.
        """
        lines = self.settled
        if lines is None:
            lines = self.lines().where(LANDED).select("lo", "hi", "piece", "n_null_keys").collect()
        nulls = sorted((r.piece, r.n_null_keys) for r in lines if r.lo is None)[:1]
        taken, at = [(piece, None, n) for piece, n in nulls], None
        for line in sorted((r for r in lines if r.lo is not None), key=lambda r: (r.lo, -r.hi, r.piece)):
            if at is None or line.hi > at:
                taken.append((line.piece, at + 1 if at is not None and at >= line.lo else None, 0))
                at = line.hi
        return taken

    def data(self) -> DataFrame:
        """The flagged rows of all landed slices."""
        kind = T.StructType([*heal.flagged_schema(self.schema).fields, T.StructField(PIECE, T.StringType())])
        pieces = self.pieces()
        if not pieces:
            return self.spark.createDataFrame([], kind)
        read = self.spark.read.schema(kind).option("basePath", self.root)
        rows = read.parquet(*[f"{self.root}/{PIECE}={piece}" for piece, _, _ in pieces])
        for piece, lo, _ in pieces:
            if lo is not None:
                first = (lo - self.plan.lo) // self.plan.width
                rows = rows.where(f"{PIECE} <> '{piece}' OR {INDEX} >= {first}")
        return rows

    def unread(self) -> DataFrame:
        """The report on ranges that cannot be read, one line each; those landed since are left out."""
        before = Window.orderBy("lo").rangeBetween(Window.unboundedPreceding, Window.currentRow)
        upto = F.max(F.when(F.expr(LANDED), F.col("hi"))).over(before)
        lines = self.lines().where("lo IS NOT NULL").withColumn("upto", upto)
        open_ = lines.where(UNREAD).where("upto IS NULL OR upto < hi").groupBy("lo", "hi").agg(F.max("error").alias("first_error"))
        index = self.plan.index_of("lo")
        return open_.selectExpr(
            f"{index} AS {INDEX}", "lo", "hi", "hi - lo + 1 AS expected_rows", "CAST(NULL AS BIGINT) AS n_bad", "first_error"
        )

    def report(self) -> DataFrame:
        """Ranges with values that do not fit, and those that cannot be read."""
        n_null = sum(n for _, _, n in self.pieces())
        key = self.key or self.options.key
        bad = heal.verdict_of(self.data().where(heal.BAD), key, self.plan, n_null)
        return bad.unionByName(self.unread())

    def loaded(self) -> Loaded:
        """Rows and failures as the policy has them, from what is in the folder."""
        spark, options = self.spark, self.options
        self.settled = self.lines().where(LANDED).select("lo", "hi", "piece", "n_null_keys").collect()
        report = cut_lineage(self.report())
        n_failed = report.count()
        refused = {"fail": "true", "safe": "n_bad IS NULL" if self.unreadable == "fail" else "false"}
        line = report.where(refused.get(options.on_error, "false")).first() if n_failed else None
        if line is not None:
            raise RuntimeError(f"keys {line.lo} to {line.hi}: {line.first_error}")
        columns = [INDEX, *map(quoted, self.schema.names)]
        data = self.data()
        rows = data.where(f"NOT {heal.BAD}") if options.heals else data
        tags = [ROW_TAG] if options.ordered else []
        rows = (with_row_tag(rows) if tags else rows).selectExpr(*columns, *tags)
        if n_failed and options.heals:
            rows = heal.without_failed(rows, heal.Verdict(report, n_failed))
            rows = rows.unionByName(heal.null_rows(report, self.schema, options.ordered))
        elif n_failed:
            lost = report.where("n_bad IS NULL")
            rows = rows.unionByName(heal.null_rows(lost, self.schema, options.ordered))
        if options.ordered:
            key = self.key or next((n for n in self.schema.names if n.lower() == options.key.lower()), self.schema.names[0])
            rows = rows.orderBy(*[INDEX] * (options.heals or self.unreadable == "null_rows"), quoted(key), ROW_TAG)
        chosen = rows.select(*[INDEX] * options.with_index, *map(quoted, self.schema.names))
        made = Loaded(chosen, lambda: None if self.plan is NO_KEYS else self.plan, lambda: report)
        made.landing = self.root
        return made

    def run(self, connections: int, max_slices: int) -> Loaded:
        note = {"of": json.loads(self.manifest), "hi": self.plan.hi, "null_keys": self.options.null_keys,
                "key": self.options.key, "no_keys": self.plan is NO_KEYS}
        append_file(self.spark, f"{self.root}/plan/{uuid.uuid4().hex}.json", json.dumps(note))
        runs = [] if self.plan is NO_KEYS else self.slices(max_slices)
        with ThreadPoolExecutor(connections) as pool:
            jobs = [pool.submit(self.land, a, b) for a, b in runs]
            if self.options.null_keys == "keep" and self.read_nulls is not None:
                jobs.append(pool.submit(self.land_nulls))
            try:
                for job in jobs:
                    job.result()
            except Exception:
                pool.shutdown(wait=True, cancel_futures=True)
                raise
        return self.loaded()


def _covers(plan: RangePlan, lo: int, hi: int) -> bool:
    """Whether key bounds are those of whole ranges of a plan."""
    return (lo - plan.lo) % plan.width == 0 and plan.lo <= lo and hi <= plan.hi and (
        hi == plan.hi or (hi + 1 - plan.lo) % plan.width == 0
    )


def _aligned(plan: RangePlan) -> str:
    """:func:`_covers` as SQL, for the lines of a log."""
    start, width = f"CAST({plan.lo} AS DECIMAL(38,0))", f"CAST({plan.width} AS DECIMAL(38,0))"
    end = f"(hi = {plan.hi} OR (hi + 1 - {start}) % {width} = 0)"
    return f"(lo - {start}) % {width} = 0 AND lo >= {start} AND hi <= {plan.hi} AND {end}"


def read_log(spark: SparkSession, root: str) -> DataFrame:
    """The log of a landing: ``lo, hi, piece, rows, n_bad, n_null_keys, error``, and when a slice was read."""
    if not exists(spark, f"{root}/log"):
        return spark.createDataFrame([], _LINE)
    return spark.read.schema(_LINE).json(f"{root}/log")


def most_at_once(lines: DataFrame) -> int:
    """How many slices of a log (a line each, on the driver) were read at the same time, at most."""
    landed = lines.where(LANDED).select("began", "ended").collect()
    times = [(r.began, 1) for r in landed] + [(r.ended, -1) for r in landed]
    running = most = 0
    for _, change in sorted(times, key=lambda t: (t[0], t[1])):
        running += change
        most = max(most, running)
    return most


def read_landing(spark: SparkSession, root: str, *, on_error: str = "null_partition", unreadable: str = "fail", **options) -> Loaded:
    """What was landed in a folder (``Loaded.landing``), without a look at the source.

    Rows and failures are those of the load, finished or not, under any policy: of the
    ranges landed so far, and those found unreadable. ``on_error="fail"`` and, under
    ``"safe"``, ``unreadable="fail"`` raise if there are such failures.
    """
    root = qualified(spark, root).rstrip("/")
    if not exists(spark, f"{root}/plan"):
        raise FileNotFoundError(f"{root}: not a landing")
    # Plans of one landing differ in their last key only; the widest has them all.
    note = max((json.loads(r.value) for r in spark.read.text(f"{root}/plan").collect()), key=lambda n: n["hi"])
    label, kind, key, check_utf8, rule, lo, width = note["of"]
    plan = NO_KEYS if note["no_keys"] else RangePlan(lo, note["hi"], width)
    chosen = LoadOptions(
        key=key, on_error=on_error, null_keys=note["null_keys"], check_utf8=check_utf8, rule=rule, **options
    )
    landing = Landing(spark, None, plan, T.StructType.fromJson(json.loads(kind)), "/", chosen, label, unreadable=unreadable)
    landing.root = root
    return landing.loaded()


def land_ranges(
    spark: SparkSession,
    read_range: Callable[[int, int], DataFrame],
    plan: RangePlan,
    schema: T.StructType,
    directory: str,
    *,
    key: str = "id",
    label: str = "",
    connections: int = 8,
    max_slices: int = MAX_SLICES,
    on_error: str = "null_partition",
    unreadable: str = "fail",
    max_failed: int | None = None,
    **options,
) -> Loaded:
    """Land ``read_range(lo, hi)`` for every slice and settle the ranges that fail.

    At most ``connections`` slices are read at a time. The driver holds one line per
    slice, never rows. ``directory`` must be shared by all executors; ``label`` names what
    is read there, so that another source does not meet its slices. For ``unreadable`` and
    ``max_failed`` see :func:`load_landed`.
    """
    landing = Landing(
        spark, read_range, plan, schema, directory, LoadOptions(key=key, on_error=on_error, **options), label,
        unreadable=unreadable, max_failed=max_failed,
    )
    return landing.run(connections, max_slices)


def load_landed(
    spark: SparkSession,
    spec: LoadSpec | Mapping | str,
    directory: str,
    rows_per_partition: int = 0,
    *,
    parallelism: int | None = None,
    connections: int = 8,
    max_slices: int | None = None,
    split_by: str | None = None,
    splits: int = 1,
    on_error: str = "null_partition",
    unreadable: str = "fail",
    max_failed: int | None = None,
    **options,
) -> Loaded:
    """Load a spec's query through :class:`Landing`, with the options of :func:`rangeloom.load`.

    A query on the session is scanned once, and again only for halves of a part that cannot
    be read; ``max_slices`` sets another number of scans. At most ``connections`` statements
    run at a time, parts of a split range counted.

    A range that cannot be read at all becomes ``expected_rows`` NULL rows under
    ``on_error="null_partition"``. Under ``"safe"`` it ends the load, or becomes such rows
    with ``unreadable="null_rows"``. NULL keys that cannot be read end any load that keeps
    them. A load gives up after ``max_failed`` unreadable ranges, if that is set.
    """
    spec = as_spec(spec)
    options = LoadOptions(on_error=on_error, **options)
    cores = parallelism or default_parallelism(spark)
    if spec.runs_on_session:
        source = queries.query_as_source(spark, spec.query)
        column = source.columns[queries.key_position(source.schema, options.key)]
        bounds = queries.key_bounds(source, column)
        read, test, label = source.where, quoted(column), spec.query
    else:
        bounds = jdbc.jdbc_key_bounds(spark, spec, options.key)
        test = options.key
        # Where the rows come from, without who reads them.
        label = f"{jdbc_options(spec.connection_string)['url'].partition('?')[0]} {spec.query}"

        def read(predicate: str) -> DataFrame:
            return jdbc.read_parts(spark, spec, predicate, split_by, splits)

    plan = make_plan(bounds, cores, rows_per_partition)
    if plan is None:
        if options.null_keys != "keep":
            return Loaded(empty_result(spark, spec.schema), lambda: None)
        plan = NO_KEYS
    landing = Landing(
        spark, lambda lo, hi: read(f"{test} BETWEEN {lo} AND {hi}"), plan, spec.schema, directory, options,
        label, lambda: read(f"{test} IS NULL"), max_failed, unreadable,
    )
    loaded = landing.run(max(1, connections // splits), max_slices or (1 if spec.runs_on_session else MAX_SLICES))
    loaded.batch_size = spec.batch_size
    return loaded
