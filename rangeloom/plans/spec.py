"""The load spec: where the rows come from and what their columns are called.

A spec is a small YAML file or dict::

    connection_string: postgresql://user:password@host:5432/db
    query: SELECT id, name, score, created_at FROM users
    schema:
      - {column_name: id, arrow_type: Int64}
      - {column_name: name, arrow_type: Utf8}
      - {column_name: score, arrow_type: Float32}
      - {column_name: created_at, arrow_type: "Timestamp(Nanosecond, None)"}
    batch_size: 65536        # optional

``connection_string`` is a database URL, a ``jdbc:`` URL, a ``key=value`` list, or
``spark`` to run the query on the session itself, where it can name tables, views
and files alike.
"""

from __future__ import annotations

import re
import shlex
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any
from urllib.parse import parse_qsl, unquote, urlsplit

from pyspark.sql import types as T

from rangeloom.functions.types import struct_of

# Fixed value: rows per batch when the spec names none.
DEFAULT_BATCH_SIZE = 65_536

SESSION_SOURCE = "spark"

_ENVELOPE = re.compile(
    r"^\s*COPY\s*\((?P<query>.*)\)\s*TO\s+STDOUT\s*(?:WITH\s*)?\(\s*FORMAT\s+\"?BINARY\"?\s*\)\s*;?\s*$",
    re.IGNORECASE | re.DOTALL,
)
_BARE = re.compile(r"^\s*(SELECT|WITH|TABLE|VALUES|FROM|\()", re.IGNORECASE)


class SpecError(ValueError):
    """A load spec that cannot be used."""


def inner_query(query: str) -> str:
    """The SELECT of a bare or enveloped query, one pair of parentheses removed."""
    enveloped = _ENVELOPE.match(query)
    if enveloped:
        return enveloped["query"].strip()
    if not _BARE.match(query):
        raise SpecError("query is neither a SELECT nor a binary COPY (SELECT ...) TO STDOUT")
    return query.strip().rstrip(";").strip()


def jdbc_options(connection_string: str) -> dict[str, str]:
    """JDBC reader options for a database URL, a ``jdbc:`` URL or a ``key=value`` list."""
    text = connection_string.strip()
    if text.startswith("jdbc:"):
        return {"url": text}
    if re.match(r"^postgres(ql)?://", text):
        parts = urlsplit(text)
        host = parts.netloc.rpartition("@")[2] or "localhost"
        options = dict(parse_qsl(parts.query))
        user, password, database = parts.username, parts.password, parts.path.lstrip("/")
        user, password = (unquote(x) if x else x for x in (user, password))
    elif "=" in text and "://" not in text:
        options = dict(item.split("=", 1) for item in shlex.split(text))
        host = options.pop("host", "localhost")
        if "port" in options:
            host = f"{host}:{options.pop('port')}"
        user, password = options.pop("user", None), options.pop("password", None)
        database = options.pop("dbname", user or "")
    else:
        raise SpecError("connection_string is no URL and no key=value list")
    found = {"url": f"jdbc:postgresql://{host}/{database}", "driver": "org.postgresql.Driver"}
    secrets = {"user": user, "password": password}
    return found | {k: v for k, v in secrets.items() if v} | options


@dataclass(frozen=True)
class LoadSpec:
    """A validated spec. Its text form never shows the connection string."""

    connection_string: str = field(repr=False)
    query: str
    columns: tuple[tuple[str, str], ...]
    batch_size: int = DEFAULT_BATCH_SIZE

    def __post_init__(self) -> None:
        if not self.connection_string.strip():
            raise SpecError("connection_string is empty")
        if not self.query.strip():
            raise SpecError("query is empty")
        inner_query(self.query)
        if not self.columns:
            raise SpecError("schema has no columns")
        names = [name.lower() for name, _ in self.columns]
        if len(set(names)) < len(names):
            raise SpecError("schema repeats a column name")
        if self.batch_size < 1:
            raise SpecError("batch_size is not positive")
        struct_of(self.columns)

    @property
    def schema(self) -> T.StructType:
        return struct_of(self.columns)

    @property
    def select(self) -> str:
        return inner_query(self.query)

    @property
    def runs_on_session(self) -> bool:
        return self.connection_string.strip().lower() == SESSION_SOURCE

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> LoadSpec:
        missing = [k for k in ("connection_string", "query", "schema") if k not in raw]
        if missing:
            raise SpecError(f"missing field: {', '.join(missing)}")
        try:
            columns = tuple((c["column_name"], c["arrow_type"]) for c in raw["schema"] or ())
        except (KeyError, TypeError):
            raise SpecError("each schema entry needs column_name and arrow_type") from None
        batch_size = raw.get("batch_size")
        return cls(
            raw["connection_string"] or "",
            raw["query"] or "",
            columns,
            DEFAULT_BATCH_SIZE if batch_size is None else int(batch_size),
        )

    @classmethod
    def from_yaml(cls, path: str) -> LoadSpec:
        try:
            import yaml
        except ImportError as error:
            raise SpecError("reading a YAML spec needs PyYAML; use LoadSpec.from_dict") from error
        with open(path, encoding="utf-8") as handle:
            raw = yaml.safe_load(handle)
        if not isinstance(raw, Mapping):
            raise SpecError("the spec file does not hold a mapping")
        return cls.from_dict(raw)


def as_spec(spec: LoadSpec | Mapping[str, Any] | str) -> LoadSpec:
    """A spec from an object, a mapping or the path of a YAML file."""
    if isinstance(spec, LoadSpec):
        return spec
    return LoadSpec.from_yaml(spec) if isinstance(spec, str) else LoadSpec.from_dict(spec)
