import json
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from lodestrata.session import session

    s = session("local[4]", 4, **{"spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from dicts, the id taken from each."""

    def make(*items):
        return spark.createDataFrame([(str(d["id"]), json.dumps(d)) for d in items] or [], "data_id string, data string")

    return make


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
