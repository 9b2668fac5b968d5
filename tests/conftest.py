import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))

from checks.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return session(cpus=4, memory="4g")
