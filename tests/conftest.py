import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from eventloom.session import build_session

    ckpt = tempfile.mkdtemp(prefix="eventloom-test-ckpt-")
    session = build_session(
        "local[*]",
        app_name="eventloom-tests",
        shuffle_partitions=8,
        extra={"spark.checkpoint.dir": ckpt},
    )
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir(spark):
    from eventloom.session import scratch_path

    return scratch_path(spark, "test")
