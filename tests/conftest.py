import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

from caseloom.session import local_session  # noqa: E402
from caseloom.sources.readers import inline_rows  # noqa: E402

from . import tables  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(shuffle_partitions=4, app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def case(spark):
    """``case("sales")``: one of the small business-case tables with its declared schema."""
    return lambda name: inline_rows(spark, name, tables.ROWS[name])


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
