import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gigloom.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session("local[8]", app="tests", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
                                            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture
def values(spark):
    """Evaluate a Column function over a list of strings."""
    def run(fn, items):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i int, v string")
        return [tuple(r.o) if isinstance(r.o, tuple) else r.o for r in df.select("i", fn("v").alias("o")).orderBy("i").collect()]
    return run
