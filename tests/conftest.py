from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from strata.session import build_session, release_scratch  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    conf = {"spark.checkpoint.dir": f"file://{shared}", "spark.ui.showConsoleProgress": "false"}
    session = build_session("local[*]", app_name="strata-tests", shuffle_partitions=8, conf=conf)
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def release(request):
    """Delete what a test wrote to the shared folder."""
    yield
    if "spark" in request.fixturenames:
        release_scratch(request.getfixturevalue("spark"))


@pytest.fixture
def shuffle_partitions(spark):
    """Temporarily change spark.sql.shuffle.partitions."""
    old = spark.conf.get("spark.sql.shuffle.partitions")

    def set_to(n: int) -> None:
        spark.conf.set("spark.sql.shuffle.partitions", str(n))

    yield set_to
    spark.conf.set("spark.sql.shuffle.partitions", old)
