import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ticketmill.session import Workspace, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return build_session("local[4]", shuffle_partitions=4)


@pytest.fixture()
def ws(spark):
    return Workspace(spark)
