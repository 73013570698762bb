import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("RANGEHAUL_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from rangehaul.session import load_session

    session = load_session(
        "rangehaul-tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture
def scratch(spark):
    from rangehaul.session import scratch_path

    return lambda name="test": scratch_path(spark, name)
