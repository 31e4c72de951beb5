import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from formbook.local import local_session  # noqa: E402
from formbook.schemas import REQUIRED_COLUMNS  # noqa: E402
from rows import MATCH_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", "4")


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def make(spark):
    def build(rows):
        return spark.createDataFrame(rows, MATCH_SCHEMA)

    assert set(REQUIRED_COLUMNS) <= set(build([]).columns)
    return build
