"""One session for all tests; its files go to pytest's temporary folder."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from recordscope.session import build_session

    top = tmp_path_factory.mktemp("spark")
    session = build_session("local[4]", "tests", **{"spark.checkpoint.dir": str(top / "shared"), "spark.sql.warehouse.dir": str(top / "warehouse"), "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "3g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
