import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ascentframe.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        "tests",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def hot_groups(spark):
    """Makes every group over a few rows take the split path."""
    from ascentframe.operators.ordered import HOT_ROWS_CONF

    def limit(rows: int) -> None:
        spark.conf.set(HOT_ROWS_CONF, str(rows))

    yield limit
    spark.conf.unset(HOT_ROWS_CONF)
