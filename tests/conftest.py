import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from upkeep.schema import RECORD_SCHEMA  # noqa: E402
from upkeep.session import get_spark  # noqa: E402

SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", 8, app_name="upkeep-tests", extra={"spark.ui.enabled": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rec(building_id=1, asset_type="HVAC", date="2024-01-01 00:00:00", mtype="preventive", failure=False,
        downtime=0, cost=100.0, technician=7, period=30, city="Tirana", country="Albania", area=1000.0,
        floors=5, building_type="residential"):
    return (building_id, building_type, asset_type, mtype,
            datetime.fromisoformat(date) if date else None, failure, downtime, cost, technician, period,
            city, country, area, floors)


@pytest.fixture
def make_records(spark):
    def make(rows):
        return spark.createDataFrame(rows, RECORD_SCHEMA)
    return make
