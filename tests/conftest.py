import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from panelforge.session import build_session, checkpoint_dir

    s = build_session("local[4]", 8, app="panelforge-tests")
    # tests run on one machine: use a fresh local folder only when the session names none
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="pf-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF
