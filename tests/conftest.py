import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tonegrain.session import local_session  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = local_session(os.environ.get("TEST_CPUS", "4"), shuffle_partitions=4, app="tonegrain-tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.001"


def plan_of(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return df._jdf.queryExecution().explainString(mode)
