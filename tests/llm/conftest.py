import os

import pytest

from .helpers import SF


@pytest.fixture(autouse=True)
def needs_the_driver_tables():
    if not os.path.isdir(SF):
        pytest.skip("driver test tables not present")
