import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidepool.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=4, partitions=4, app="tests")


@pytest.fixture(scope="session")
def sf():
    return SF


def rows(df, *order):
    return sorted((tuple(r) for r in df.select(*order).collect()) if order
                  else (tuple(r) for r in df.collect()), key=repr)
