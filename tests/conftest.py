import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from contractcheck.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of dictionaries."""

    def take(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((r.asDict(recursive=True) for r in picked.collect()), key=repr)

    return take
