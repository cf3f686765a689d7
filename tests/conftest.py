import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pairloom.session import build_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    conf = {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
    }
    session = build_session("tests", "local[8]", **conf)
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture
def pairs_of(spark):
    """A pair table from ``(lang, raw, clean)`` rows, numbered from 0."""

    def build(*rows):
        numbered = [(i, *row) for i, row in enumerate(rows)]
        return spark.createDataFrame(numbered, "id bigint, lang string, raw string, clean string")

    return build
