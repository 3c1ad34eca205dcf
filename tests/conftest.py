import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from eventide.session import local

    session = local(cores=4, partitions=4, checkpoint="file://" + str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()
