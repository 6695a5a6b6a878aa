import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfwise.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("8", shuffle_partitions=2, memory="6g")


@pytest.fixture
def rows():
    """Collected rows as a sorted list of plain tuples."""

    def collect(df, *cols):
        def plain(value):
            return tuple(value) if isinstance(value, list) else value

        picked = df.select(*cols) if cols else df
        return sorted(
            (tuple(plain(x) for x in r) for r in picked.collect()),
            key=lambda t: [(x is None, str(type(x)), x) for x in t],
        )

    return collect
