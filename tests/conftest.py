import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from storyloom.session import build_session

    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    os.environ["PYTHONPATH"] = os.path.dirname(os.path.dirname(os.path.abspath(__file__))) + os.pathsep + os.environ.get("PYTHONPATH", "")
    s = build_session("tests", "local[4]", 4, **{"spark.ui.enabled": "false", "spark.driver.memory": "3g", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
