import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rostermart.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=4, shuffle_partitions=4, app="rostermart-tests")


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SF_DIR).exists():
        pytest.skip("test tables are not here")
    return SF_DIR


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
