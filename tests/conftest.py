import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sediment.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def rows():
    """Sorted tuples of a small frame."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
