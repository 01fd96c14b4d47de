import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from holdcast.session import checkpoint_dir, local_session
    s = local_session("*", shuffle_partitions=8, app_name="holdcast-tests")
    if not s.sparkContext.getConf().get("spark.checkpoint.dir", None):
        # Only when the environment names no shared folder (as on a laptop).
        checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="holdcast-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables_small(spark):
    from holdcast.sources.fixtures import load_tables
    return load_tables(spark, SF_SMALL)


@pytest.fixture(scope="session")
def tables_oracle(spark):
    from holdcast.sources.fixtures import load_tables
    return load_tables(spark, SF_ORACLE)
