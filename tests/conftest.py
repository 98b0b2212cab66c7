import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from taskloom import session

    s = session.prepare(session.build("local[4]", partitions=4, memory="4g"))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    if not DATA.exists():
        pytest.skip("the test tables are not mounted")
    return str(DATA)
