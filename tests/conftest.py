import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from spreadkit.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="*", shuffle_partitions=8, app="spreadkit-tests")
    yield session
    session.stop()


@pytest.fixture
def make_points(spark):
    def build(rows):
        return spark.createDataFrame(
            [(int(i), [float(x) for x in v]) for i, v in rows], "id bigint, vec array<double>"
        )

    return build


# Fixture C of FIXTURES.md.
FIXTURE_C = [(0, (0, 0)), (1, (1, 0)), (2, (0, 1)), (3, (10, 0)), (4, (0, 8)), (5, (9, 1))]
