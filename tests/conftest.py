import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pulselake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("pulselake-tests", cores=8, memory="6g")
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted([tuple(r) for r in picked.collect()], key=repr)
