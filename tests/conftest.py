import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from cohortloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def write(tmp_path):
    """Write a text file and return its path."""
    def _write(name, text):
        path = tmp_path / name
        path.write_text(text)
        return str(path)
    return _write


def rows(df, *cols):
    """Rows as a sorted list of tuples."""
    out = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(out, key=lambda t: tuple((v is None, str(v)) for v in t))
