from __future__ import annotations

import os

import pytest

from tidemill.session import build_session

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {
        "spark.master": "local[4]",
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    session = build_session("tests", conf)
    session.sparkContext.setLogLevel("OFF")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_sf() -> str:
    path = f"{TESTDATA}/sf0.001"
    if not os.path.isdir(path):
        pytest.skip(f"no tables in {path}")
    return path
