from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from keyflow.session import build_session

    warehouse = tempfile.mkdtemp(prefix="keyflow-wh-")
    s = build_session("local[4]", app="keyflow-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture
def tmp(spark, tmp_path):
    """A fresh folder for tables written by one test."""
    return str(tmp_path)
