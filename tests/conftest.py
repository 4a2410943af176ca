import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from fundlens.session import local_session

    s = local_session("*", 8, app_name="fundlens-tests")
    # Tests run without a cluster: give the session its own checkpoint folder.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fundlens-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL
