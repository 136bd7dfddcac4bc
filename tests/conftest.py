import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import local_session

    work = tmp_path_factory.mktemp("checkpoints")
    s = local_session("tidemark-tests", cores="*", shuffle_partitions=8, checkpoint_dir=f"file://{work}")
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    """A fresh folder per test (local runs only; on a cluster use shared_base)."""
    return str(tmp_path)
