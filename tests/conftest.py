import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from fleetlake.session import build_session
    wh = str(tmp_path_factory.mktemp("warehouse"))
    s = build_session("local[4]", 4, app="fleetlake-tests", extra={"spark.sql.warehouse.dir": wh})
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("ckpt")))
    yield s


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
