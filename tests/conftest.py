import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lexisift.session import build_session
    session = build_session("tests", master="local[4]", shuffle_partitions=4, **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def corpus(spark):
    """Six documents small enough to score by hand."""
    return spark.createDataFrame(
        [(1, "x", "red red apple"), (2, "x", "red pear"), (3, "x", "apple"),
         (4, "y", "blue pear"), (5, "y", "blue"), (6, "y", None)],
        "doc_id long, category string, text string")
