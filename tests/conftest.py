import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallymark.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tallymark-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def base(spark):
    from tallymark.plans.workspace import workspace

    return workspace(spark, SF)


@pytest.fixture(scope="session")
def faulty(spark):
    from tallymark.plans.workspace import workspace

    return workspace(spark, SF, faulty=True)
