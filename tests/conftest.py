import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from farebox.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("intermediate"))
    session = local_session("farebox-tests", cores=4, folder=folder)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """A frame of hand-written rows."""

    def make(schema, *values):
        return spark.createDataFrame(list(values), schema)

    return make
