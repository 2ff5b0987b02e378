"""Strict and safe casts between a source column and its declared type.

Every cast is one SQL value (NULL where the source value does not fit) and, unless
the conversion cannot fail, one SQL test saying whether a non-NULL value did not fit.
Strict, safe and per-range handling are all built from these two, so they never
disagree, and none of them depends on the session's ANSI setting.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rangeloom.functions.names import quoted
from rangeloom.functions.types import declared_name

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)
_WIDTH = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8}

# Error messages show this much of a value that does not fit. Only the message is cut.
MESSAGE_CHARS = 200

# The spellings of infinity, in small letters.
_INFINITY = ("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")


@dataclass(frozen=True)
class TypedValue:
    """A column and its declared type; ``failed`` is None if every value fits."""

    name: str
    target: T.DataType
    value: str
    failed: str | None

    @property
    def message(self) -> str:
        """SQL for a text naming the column, the offending value and the declared type."""
        # Bytes that are not text are shown in hex.
        raw = quoted(self.name)
        shown = f"hex({raw})" if isinstance(self.target, T.StringType) else f"CAST({raw} AS STRING)"
        before = sql_text(f"column '{self.name}': '")
        after = sql_text(f"' is not {declared_name(self.target)}")
        return f"concat({before}, substring({shown}, 1, {MESSAGE_CHARS}), {after})"

    @property
    def safe(self) -> str:
        """SQL for the value, or NULL where it does not fit; the row is kept."""
        return f"{self.value} AS {quoted(self.name)}"

    @property
    def strict(self) -> str:
        """SQL for the value, failing the job on the first one that does not fit."""
        if self.failed is None:
            return self.safe
        kind = self.target.simpleString()
        tested = f"CASE WHEN {self.failed} THEN raise_error({self.message}) ELSE {self.value} END"
        return f"CAST({tested} AS {kind}) AS {quoted(self.name)}"


def sql_text(text: str) -> str:
    """A string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _always_fits(source: T.DataType, target: T.DataType) -> bool:
    if isinstance(source, T.NullType):
        return True
    if isinstance(source, _WHOLE):
        if isinstance(target, _WHOLE):
            return _WIDTH[type(source)] <= _WIDTH[type(target)]
        return isinstance(target, (T.FloatType, T.DoubleType, T.StringType, T.BooleanType))
    if isinstance(source, _FRACTIONAL):
        return isinstance(target, (T.FloatType, T.DoubleType, T.StringType, T.BooleanType))
    if isinstance(source, (T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)):
        return not isinstance(target, _WHOLE)
    return False


def typed_value(
    name: str, source: T.DataType, target: T.DataType, check_utf8: bool = False
) -> TypedValue:
    """Pair a source column with its declared type.

    A column that already has the declared type passes through untouched, which
    keeps filters on it pushable to the scan. ``check_utf8`` also validates the
    bytes of columns that arrive as text; binary columns are always validated.
    """
    raw, kind = quoted(name), target.simpleString()
    text = isinstance(target, T.StringType)
    if text and (isinstance(source, T.BinaryType) or (check_utf8 and isinstance(source, T.StringType))):
        value = f"try_validate_utf8(CAST({raw} AS STRING))"
        return TypedValue(name, target, value, f"({raw} IS NOT NULL AND {value} IS NULL)")
    if source == target:
        return TypedValue(name, target, raw, None)
    value = raw
    if isinstance(source, T.TimestampType):
        # An instant is read at UTC, whatever the session's zone.
        value = f"timestampadd(MICROSECOND, unix_micros({raw}), timestamp_ntz'1970-01-01 00:00:00')"
    if isinstance(source, _FRACTIONAL) and isinstance(target, _WHOLE):
        # SQL casts of fractions to integers round; Spark's truncates. Floats round
        # ties to even, decimals away from zero.
        value = f"round({raw}, 0)" if isinstance(source, T.DecimalType) else f"rint({raw})"
    value = f"try_cast({value} AS {kind})"
    finite = _is_finite(raw, source)
    if isinstance(target, (T.FloatType, T.DoubleType)) and finite and source != T.FloatType():
        # A finite value that only infinity could stand for does not fit.
        value = f"CASE WHEN abs({value}) = {kind}('infinity') AND {finite} THEN NULL ELSE {value} END"
    elif _always_fits(source, target):
        return TypedValue(name, target, value, None)
    return TypedValue(name, target, value, f"({raw} IS NOT NULL AND {value} IS NULL)")


def _is_finite(raw: str, source: T.DataType) -> str | None:
    """SQL test that a value of a type that can be cast to infinity is finite itself."""
    if isinstance(source, T.DoubleType):
        return f"abs({raw}) < double('infinity')"
    if isinstance(source, T.StringType):
        spelled = ", ".join(map(sql_text, _INFINITY))
        return f"lower(trim({raw})) NOT IN ({spelled})"
    return None


def text_is_valid(text: Column) -> Column:
    """Whether the bytes of a text or binary column are valid UTF-8."""
    return F.is_valid_utf8(text.cast("string"))
