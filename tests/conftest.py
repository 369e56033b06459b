import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wattline.session import GROUP_ROWS_CONF, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_groups(spark):
    """Every series above 40 rows counts as too long for one task."""
    spark.conf.set(GROUP_ROWS_CONF, "40")
    yield
    spark.conf.unset(GROUP_ROWS_CONF)
