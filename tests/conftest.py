import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from almanac.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
        spark__driver__host="127.0.0.1", spark__driver__bindAddress="127.0.0.1",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    def collect(df, *columns):
        return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]

    return collect
