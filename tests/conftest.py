import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))
os.environ.setdefault("PYTHONPATH", ROOT)


@pytest.fixture(scope="session")
def spark():
    from replyloom.session import local_session

    s = local_session("4", "tests", spark_sql_shuffle_partitions="4")
    yield s
    s.stop()
