import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlake.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.chdir(tmp_path_factory.mktemp("work"))  # saved tables go here, not into the repository
    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def as_set(df, *columns):
    rows = df.select(*columns) if columns else df
    return {tuple(row) for row in rows.collect()}
