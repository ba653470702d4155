import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("BENCH_CPUS", "4")
from sluice.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"
#: Made before the test modules are read: columns at their top need it.
SESSION = local_session("tests", memory="4g")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def one(spark):
    """The value of a column expression over one row of literals."""

    def run(column, **values):
        types = ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'double' if isinstance(v, float) else 'long'}" for k, v in values.items())
        return spark.createDataFrame([tuple(values.values())], types).select(column.alias("x")).first()["x"]

    return run
