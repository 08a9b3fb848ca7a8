import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, os.environ.get("PYTHONPATH")) if x)


@pytest.fixture(scope="session")
def spark():
    from gustloom.session import session

    s = session("local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g", spark__sql__autoBroadcastJoinThreshold="1m")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
