import os
import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), str(ROOT / "tests"), os.environ.get("PYTHONPATH", "")]).rstrip(os.pathsep)

SMALL_DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from check_oracles import session
    return session("4")


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", SMALL_DATA)


@pytest.fixture
def objects(spark):
    def make(pairs):
        return spark.createDataFrame(pairs, "key string, size bigint")
    return make
