import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from hirelake.session import configure, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = configure(local_session(8, "8g", "tests"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def values(df, *columns):
    return [tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()]
