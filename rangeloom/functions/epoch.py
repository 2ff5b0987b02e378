"""Database-epoch integers to dates and timestamps, and back.

All results are zone-free (``timestamp_ntz`` / ``date``), so they do not depend
on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The database epoch, and the integers it stores for +-infinity.
EPOCH_TIMESTAMP = "2000-01-01 00:00:00"
EPOCH_MICROS = 946_684_800_000_000
EPOCH_DAYS = 10_957
INFINITE_MICROS = (-(2**63), 2**63 - 1)
INFINITE_DAYS = (-(2**31), 2**31 - 1)

_EPOCH_NTZ = f"timestamp_ntz'{EPOCH_TIMESTAMP}'"


def _finite(value: Column, infinities: tuple[int, int], safe: bool, what: str) -> Column:
    infinite = value.isin(*infinities)
    if safe:
        return F.when(~infinite, value)
    return F.when(infinite, F.raise_error(F.lit(f"infinite {what}"))).otherwise(value)


def micros_to_timestamp(micros: Column, safe: bool = False) -> Column:
    """Microseconds since 2000-01-01 as ``timestamp_ntz``.

    An infinite value raises, or becomes NULL when ``safe``; so does one too late for the type.
    """
    finite = _finite(micros.cast("long"), INFINITE_MICROS, safe, "timestamp")
    if safe:
        finite = F.when(finite <= INFINITE_MICROS[1] - EPOCH_MICROS, finite)
    return F.timestamp_add("MICROSECOND", finite, F.expr(_EPOCH_NTZ))


def timestamp_to_micros(ts: Column) -> Column:
    """Microseconds from 2000-01-01 to a ``timestamp_ntz``.

    Goes by the difference as an interval: ``timestampdiff`` would read both ends in
    the session's zone and lose the hours that a change of clocks skips.
    """
    seconds = (ts - F.expr(_EPOCH_NTZ)).cast("interval second").cast("decimal(20,6)")
    return (seconds * F.lit(1_000_000)).cast("long")


def days_to_date(days: Column, safe: bool = False) -> Column:
    """Days since 2000-01-01 as ``date``; infinities as in :func:`micros_to_timestamp`."""
    finite = _finite(days.cast("int"), INFINITE_DAYS, safe, "date")
    if safe:
        finite = F.when(finite <= INFINITE_DAYS[1] - EPOCH_DAYS, finite)
    return F.date_from_unix_date((finite + F.lit(EPOCH_DAYS)).cast("int"))


def date_to_days(day: Column) -> Column:
    """Days from 2000-01-01 to a ``date``."""
    return F.unix_date(day) - F.lit(EPOCH_DAYS)


def byte_to_boolean(byte: Column) -> Column:
    """A one-byte flag as boolean: anything but zero is true, NULL stays NULL."""
    return byte != F.lit(0)
