import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from turnstile.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    extra = {}
    # tests set their own checkpoint folder only when the cluster names none
    if not os.environ.get("SPARK_CHECKPOINT_DIR"):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="turnstile-test-ckpt-")
    s = build_session("local[4]", app="turnstile-tests", shuffle_partitions=4, extra=extra)
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    from turnstile.session import scratch_dir
    return scratch_dir(spark, "test")
