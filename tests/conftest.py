from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from rillrank.session import CHECKPOINT_DIR, build_session

    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            CHECKPOINT_DIR: str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def pairs(spark):
    """The threshold pairs in arrival order."""
    from rillrank.sources.lines import from_elements

    values = {"a": [50, 80, 400, 100, 200, 200], "b": [100, 200, 200, 500, 600, 700]}
    return from_elements(spark, [(k, v) for k, vs in values.items() for v in vs])
