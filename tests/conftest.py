import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tideline.operators import running as running_module  # noqa: E402
from tideline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = local_session(4, "tests", **{"spark.checkpoint.dir": str(folder)})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_chunks(monkeypatch):
    """Chunks of two order values, so that a few rows already span many chunks."""
    monkeypatch.setattr(running_module, "CHUNK_BITS", 1)
    monkeypatch.setattr(running_module, "TIME_CHUNK_BITS", 1)


def rows_of(df, *columns):
    """The rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=repr)
