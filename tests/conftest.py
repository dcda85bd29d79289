from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from moodtide.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, shuffle_partitions=4, app="moodtide-tests")
    if not session.conf.get("spark.checkpoint.dir", None):
        # The setting is fixed for a session's life.
        session.stop()
        shared = str(tmp_path_factory.mktemp("shared"))
        session = local_session(8, shuffle_partitions=4, app="moodtide-tests", checkpoint_dir=shared)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
