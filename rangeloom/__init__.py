"""Partitioned bulk loading of large query results into typed Spark DataFrames."""

import sys

from pyspark import cloudpickle

from rangeloom.operators.land import load_landed, read_landing
from rangeloom.operators.load import Loaded, load, load_parquet, load_table
from rangeloom.operators.profile import decode_profile, null_profile, profile_spec
from rangeloom.operators.sinks import to_arrow, to_pandas
from rangeloom.plans.ranges import RangePlan, make_plan
from rangeloom.plans.spec import LoadSpec

__all__ = [
    "LoadSpec",
    "Loaded",
    "RangePlan",
    "decode_profile",
    "load",
    "load_landed",
    "load_parquet",
    "load_table",
    "make_plan",
    "null_profile",
    "profile_spec",
    "read_landing",
    "to_arrow",
    "to_pandas",
]

# Functions sent to executors carry their code along, so that the package need not be
# installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
