"""Declared column types and the Spark types they stand for."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# The type names a load spec may use.
DECLARED_TYPES: dict[str, T.DataType] = {
    "Int64": T.LongType(),
    "Int32": T.IntegerType(),
    "Float64": T.DoubleType(),
    "Float32": T.FloatType(),
    "Utf8": T.StringType(),
    "String": T.StringType(),
    "Boolean": T.BooleanType(),
    "Timestamp(Nanosecond, None)": T.TimestampNTZType(),
    "Date32": T.DateType(),
}


def spark_type(name: str) -> T.DataType:
    """Spark type for a declared type name; any other name is refused."""
    try:
        return DECLARED_TYPES[name]
    except KeyError:
        raise ValueError(f"no Spark type for declared type {name!r}") from None


def declared_name(data_type: T.DataType) -> str:
    """The declared name shown in error messages for a Spark type."""
    for name, candidate in DECLARED_TYPES.items():
        if candidate == data_type:
            return name
    raise ValueError(f"no declared type for {data_type.simpleString()}")


def struct_of(columns: Iterable[tuple[str, str]]) -> T.StructType:
    """Ordered, all-nullable schema from ``(column name, declared type)`` pairs."""
    return T.StructType([T.StructField(name, spark_type(kind), True) for name, kind in columns])
