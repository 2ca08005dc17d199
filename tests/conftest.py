import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from sparkcivic.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, checkpoint_dir=str(tmp_path_factory.mktemp("shared")))
    yield s
    s.stop()
