import logging
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    logging.getLogger("DataFrameQueryContextLogger").setLevel(logging.CRITICAL)
    from pricelens.session import local_session
    s = local_session("*", "pricelens-tests", {"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()
