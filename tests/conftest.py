import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tripmart.session import local_session, prepare  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    )
    return prepare(session)


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def medium():
    return MEDIUM


@pytest.fixture(scope="session")
def gold_table(spark, medium):
    """The mart of the medium sample, stored once for all tests."""
    from tripmart.catalog.common import sample_gold
    from tripmart.session import materialise

    return materialise(sample_gold(spark, medium), "gold")


@pytest.fixture(scope="session")
def silver_table(spark, medium):
    from tripmart.catalog.common import sample_silver
    from tripmart.session import materialise

    return materialise(sample_silver(spark, medium), "silver")
