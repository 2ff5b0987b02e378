"""A per-row tag for spreading equal rows over several tasks.

Hashing the row's own columns cannot separate copies of one row, and a random
number is not the same again when a lost task is rerun. The place a row was read
from is both.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangeloom.plans.session import set_aside

ROW_TAG = "__row_tag"


# Kinds of plan nodes that make several rows of one, or put rows of several sources together.
_FANNING = ("Join", "Generate", "Expand", "Union", "CoGroup", "FlatMapGroupsInPandas", "FlatMapGroupsInArrow")


def _fans_out(df: DataFrame) -> bool:
    """Whether a row of a source may become several rows."""
    open_ = [df._jdf.queryExecution().optimizedPlan()]
    while open_:
        node = open_.pop()
        if node.nodeName() in _FANNING:
            return True
        below = node.children()
        open_ += [below.apply(i) for i in range(below.size())]
    return False


def with_row_tag(df: DataFrame, name: str = ROW_TAG) -> DataFrame:
    """Add a bigint tag that differs between copies and survives task reruns.

    It is a hash of the file and position a row was read from. Rows that do not come
    straight from Parquet files (a database), or of which several come from one place (a
    join, an ``explode``), are first written aside: then each has a place of its own, and
    cannot change either.
    """
    if _fans_out(df):
        df = set_aside(df)
    place = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    try:
        tagged = df.withColumn(name, place)
        tagged.schema  # resolve now
        return tagged
    except AnalysisException:
        return set_aside(df).withColumn(name, place)
