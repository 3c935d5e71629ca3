from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from netzero.session import local_session

    # managed test tables go to a throwaway warehouse, not the working dir
    s = local_session("*", shuffle_partitions=8, app="netzero-tests",
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="netzero-wh-")})
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    """Fresh folder under the shared checkpoint dir (set only if unset)."""
    from netzero.sources import scratch_path

    return lambda name="t": scratch_path(spark, name)
