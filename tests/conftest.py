import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import build_session

    base = tmp_path_factory.mktemp("spark")
    return build_session(4, "tests", **{"spark.checkpoint.dir": f"file://{base}/shared", "spark.sql.warehouse.dir": f"{base}/warehouse", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})


@pytest.fixture(scope="session")
def data():
    if not DATA.exists():
        pytest.skip("no test data")
    return str(DATA)
