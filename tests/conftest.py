import os
import tempfile

import pytest

from rangeloom.plans.session import load_session

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = load_session(
        "rangeloom-tests",
        spark__master="local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="8",
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="rangeloom-warehouse-"),
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="session")
def table(spark, folder):
    return lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
