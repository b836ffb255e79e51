from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from histlake.session import build_session
    s = build_session("histlake-tests", master="local[8]", shuffle_partitions=8)
    # tests set their own shared folder; a cluster names it in spark.checkpoint.dir
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="histlake-test-"))
    yield s
    s.stop()


@pytest.fixture()
def run_dir(spark):
    from histlake.session import new_run_dir
    return new_run_dir(spark, "test")


@pytest.fixture()
def fresh_db(spark):
    """A unique database name for one test."""
    import uuid
    return "t_" + uuid.uuid4().hex[:10]
