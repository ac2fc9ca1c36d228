import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))


@pytest.fixture(scope="session")
def spark():
    from vellum.session import session

    conf = {"spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"}
    made = session("tests", **conf)
    made.sparkContext.setLogLevel("ERROR")
    return made
