import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from steward import session  # noqa: E402

SF = "/root/testdata/sf0.01"


def make_session():
    spark = session(
        "steward-tests",
        master="local[8]",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions="8",
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="steward-warehouse-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    return make_session()


@pytest.fixture(scope="session")
def sf():
    return SF
