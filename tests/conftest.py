import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from clonarium.session import clear_scratch, local_session

    session = local_session(str(tmp_path_factory.mktemp("scratch")), 4, "clonarium-tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples, nulls first."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted(
            (tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, str(v)) for v in t]
        )

    return collect
