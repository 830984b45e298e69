from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from rillmark.session import build_session

    session = build_session(
        "tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "6g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def tight(spark):
    """Make every key hot and every lookup too big to broadcast."""
    spark.conf.set("rillmark.hotRows", "3")
    spark.conf.set("rillmark.broadcastRows", "2")
    yield spark
    spark.conf.unset("rillmark.hotRows")
    spark.conf.unset("rillmark.broadcastRows")
