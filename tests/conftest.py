import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from adtrail.session import get_spark, shared_dir

    s = get_spark("local[4]", 4, app="adtrail-tests")
    # The shared folder comes from the session (spark.checkpoint.dir) or, on a
    # local master without it, is a folder of this process.
    shared_dir(s)
    yield s


SMOKE = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
