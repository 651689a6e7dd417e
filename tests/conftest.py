import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from tagsmith.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tagsmith-wh-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tags(spark):
    from tagsmith.plans.catalog import catalog
    return catalog(spark)
