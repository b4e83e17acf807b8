import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from vitrine.session import get_session

    return get_session("local[4]", shuffle_partitions=4, app="vitrine-tests")


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="vitrine-wh-")
