from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tickloom.session import local_session  # noqa: E402

TESTDATA = os.environ.get("TICKLOOM_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4, **{"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))}
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", ""):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def sf_oracle():
    return f"{TESTDATA}/sf0.01"


@pytest.fixture
def sliced(spark):
    """Cut ordered rows into the given number of slices."""
    settings = {"spark.sql.shuffle.partitions": None, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}

    def force(slices):
        for key, value in settings.items():
            spark.conf.set(key, value or str(slices))

    yield force
    for key, value in before.items():
        spark.conf.set(key, value)
