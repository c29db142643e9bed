import os

import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tables():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables here")
    return FOLDER
