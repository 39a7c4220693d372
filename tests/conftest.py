import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from basketry.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="basketry-test-")
    session = local_session(
        8, 4, spark__sql__warehouse__dir=f"{scratch}/warehouse",
        spark__checkpoint__dir=f"{scratch}/shared",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="module", autouse=True)
def nothing_cached(spark):
    """What a module caches shows in no other module's plans."""
    yield
    spark.catalog.clearCache()
