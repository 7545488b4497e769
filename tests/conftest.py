import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martlet.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    """A local session; what queries write goes to a folder that pytest clears."""
    return local_session(8, "tests", shared=str(tmp_path_factory.mktemp("shared")))
