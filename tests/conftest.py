import sys
from contextlib import contextmanager
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from kohorta.session import BYTES_PER_TASK, ROWS_PER_TASK, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8, shuffle=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_tasks(spark):
    """Makes every group of more than ``rows`` rows count as too large for a task."""

    @contextmanager
    def limit(rows: int):
        spark.conf.set(ROWS_PER_TASK, str(rows))
        spark.conf.set(BYTES_PER_TASK, "0")
        try:
            yield
        finally:
            spark.conf.unset(ROWS_PER_TASK)
            spark.conf.unset(BYTES_PER_TASK)

    return limit
