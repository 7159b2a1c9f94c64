from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIXTURES = os.path.join(ROOT, "tests", "fixtures")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from mercato.session import local_session

    session = local_session(cores=4, shuffle_partitions=8, app_name="mercato-tests")
    yield session
    session.stop()


@pytest.fixture
def fixture_path():
    return lambda name: os.path.join(FIXTURES, name)


@pytest.fixture
def scratch(spark):
    from mercato.sources.sinks import scratch_path

    return lambda name: scratch_path(spark, name)
