import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderlake.session import ROCKSDB, build_session, prepare  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[4]", "tests", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("ckpt")), "spark.sql.streaming.stateStore.providerClass": ROCKSDB})
    session.sparkContext.setLogLevel("ERROR")
    return prepare(session)


@pytest.fixture
def sf():
    return SF


@pytest.fixture
def plan():
    """Text of the final physical plan of a frame, after it has run."""
    def text(df):
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    return text
