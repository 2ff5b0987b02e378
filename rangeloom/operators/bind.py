"""Binding a source to its declared columns by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rangeloom.functions.casts import TypedValue, typed_value
from rangeloom.functions.names import quoted

MODES = ("strict", "safe")


def rename_by_position(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give the i-th column the i-th declared name; values keep their source types."""
    if len(df.columns) != len(schema):
        raise ValueError(f"the source has {len(df.columns)} columns, the schema {len(schema)}")
    return df.toDF(*schema.names)


def typed_columns(named: DataFrame, schema: T.StructType, check_utf8: bool = False) -> list[TypedValue]:
    """Typed values of columns that already carry their declared names."""
    return [
        typed_value(f.name, named.schema[f.name].dataType, f.dataType, check_utf8)
        for f in schema.fields
    ]


def bind_types(
    named: DataFrame,
    schema: T.StructType,
    mode: str = "strict",
    keep: Sequence[str] = (),
    check_utf8: bool = False,
) -> DataFrame:
    """Cast named columns to their declared types, carrying ``keep`` along."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    typed = typed_columns(named, schema, check_utf8)
    cast = [t.safe if mode == "safe" else t.strict for t in typed]
    return named.selectExpr(*[quoted(k) for k in keep], *cast)


def positional_bind(
    df: DataFrame, schema: T.StructType, mode: str = "strict", check_utf8: bool = False
) -> DataFrame:
    """The i-th field takes the i-th declared name and type; source names are ignored.

    ``mode="strict"`` fails on the first value that does not fit, ``"safe"`` makes
    it NULL and keeps the row.
    """
    return bind_types(rename_by_position(df, schema), schema, mode, check_utf8=check_utf8)

