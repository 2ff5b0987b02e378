"""File access outside Spark readers: one rule for what a path means.

A path without a scheme is on the session's default file system, as Spark has it.
:func:`qualified` makes that explicit on the driver; executors open qualified paths.
"""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import SparkSession

# Hadoop's names of schemes that go by another name here.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def _hadoop(spark: SparkSession, path: str):
    """Spark's own file system for a path, and the path on it."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark resolves it."""
    store, place = _hadoop(spark, path)
    return store.makeQualified(place).toString()


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _hadoop(spark, path)
    return store.exists(place)


def append_file(spark: SparkSession, path: str, text: str) -> None:
    """Add a file that holds ``text``: under another name first, so that it is there whole or not at all."""
    store, place = _hadoop(spark, path)
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}.draft")
    sink = store.create(draft, True)
    sink.write(bytearray(text.encode()))
    sink.close()
    if not store.rename(draft, place):
        raise OSError(f"{path} could not be written")


def make_folder(spark: SparkSession, path: str) -> None:
    store, place = _hadoop(spark, path)
    store.mkdirs(place)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it; none is no error."""
    store, place = _hadoop(spark, path)
    store.delete(place, True)


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Have a folder of intermediate data deleted when the driver ends."""
    store, place = _hadoop(spark, path)
    store.deleteOnExit(place)


def empty_files(spark: SparkSession, path: str) -> list[str]:
    """Files of zero bytes directly at or in ``path``, which Spark's readers pass over."""
    store, place = _hadoop(spark, path)
    found = store.globStatus(place) or []
    listed = [s for f in found for s in (store.listStatus(f.getPath()) if f.isDirectory() else [f])]
    hidden = ("_", ".")
    return [
        s.getPath().toString()
        for s in listed
        if s.isFile() and s.getLen() == 0 and not s.getPath().getName().startswith(hidden)
    ]


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a qualified path, and the path within it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    scheme, found, rest = path.partition("://")
    if not found:
        raise ValueError(f"'{path}' does not say which file system it is on; qualify it first")
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}://{rest}")


def open_file(path: str):
    """A seekable input file."""
    store, inner = locate(path)
    return store.open_input_file(inner)
