import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lapforge.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, shuffle_partitions=4, name="tests")
    yield session
    session.stop()


@pytest.fixture
def database(spark, tmp_path):
    """A database in its own folder."""
    name = f"t_{abs(hash(str(tmp_path))) % 10**9}"
    spark.sql(f"create database {name} location '{tmp_path}/db'")
    yield name
    spark.sql(f"drop database {name} cascade")


def rows(df, *order):
    """Rows as plain tuples, sorted."""
    out = [tuple(r) for r in (df.select(*order) if order else df).collect()]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)) if v is None else "", v if v is not None else 0) for v in r))
