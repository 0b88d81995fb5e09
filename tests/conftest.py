import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from corpusloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    yield session
    session.stop()


@pytest.fixture
def tokens(spark):
    """Make a token table from (doc_id, category, words) rows."""

    def make(rows):
        split = [(i, c, w.split()) for i, c, w in rows]
        return spark.createDataFrame(split, "doc_id bigint, category string, tokens array<string>")

    return make
