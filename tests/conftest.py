import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(app="quarry-tests", cores=4, shuffle_partitions=8)
    yield s


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")
