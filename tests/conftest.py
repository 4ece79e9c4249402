from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from viewlog.session import get_spark

    warehouse = tempfile.mkdtemp(prefix="viewlog-test-warehouse-")
    s = get_spark("local[*]", shuffle_partitions=8, app_name="viewlog-tests",
                  extra={"spark.sql.warehouse.dir": warehouse})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="viewlog-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="viewlog-test-")
