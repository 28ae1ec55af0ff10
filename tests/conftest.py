import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from addrweave.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, "4g", "tests")
    s.sparkContext.setLogLevel("ERROR")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    return s


@pytest.fixture(scope="session")
def sf():
    return SF
