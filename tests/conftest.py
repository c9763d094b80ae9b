import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corpusloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "corpusloom-tests")


@pytest.fixture(scope="session")
def data():
    return "/root/testdata/sf0.001"
