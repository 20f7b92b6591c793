import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
tests_dir = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, tests_dir)

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shopscope.session import local_session
    ck = tempfile.mkdtemp(prefix="shopscope-test-ckpt-")
    wh = tempfile.mkdtemp(prefix="shopscope-test-warehouse-")
    s = local_session(4, 8, app="shopscope-tests",
                      extra={"spark.checkpoint.dir": ck, "spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def star(spark):
    from shopscope.plans.star import star_for
    return star_for(spark, SF001)
