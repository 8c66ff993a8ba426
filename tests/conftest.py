import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from standwise.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8)


@pytest.fixture
def rows():
    """Rows of a DataFrame as dictionaries, in the order of the given columns."""

    def read(df, *order):
        found = [r.asDict(recursive=True) for r in df.collect()]
        return sorted(found, key=lambda r: [str(r[c]) for c in order]) if order else found

    return read
