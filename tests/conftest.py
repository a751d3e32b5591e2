from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from stepwise.session import build_session

    import tempfile

    warehouse = tempfile.mkdtemp(prefix="stepwise-warehouse-")
    s = build_session("local[4]", 4, app_name="stepwise-tests", extra={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def smoke_marts(spark):
    from stepwise.plans.catalog import fixture_marts

    return fixture_marts(spark, SMOKE_DIR)
