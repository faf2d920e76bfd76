"""One Spark session for all tests."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from provgraph.session import session

    folder = tmp_path_factory.mktemp("spark")
    spark = session("local[4]", 4, "tests", **{"spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.sql.warehouse.dir": str(folder / "warehouse"), "spark.checkpoint.dir": str(folder / "shared")})
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()
