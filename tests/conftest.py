import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from spanledger.scale import SkewPolicy  # noqa: E402
from spanledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # tiny inputs: most of the time would go into compiling and re-planning
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.driver.memory": "6g",
            "spark.sql.codegen.wholeStage": "false",
            "spark.sql.codegen.factoryMode": "NO_CODEGEN",
            "spark.sql.adaptive.enabled": "false",
            "spark.default.parallelism": "2",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# one policy that never splits, one that splits nearly every key
PLAIN = SkewPolicy()
SPLIT = SkewPolicy(hot_rows=3, slot="hour", slot_width=4)


@pytest.fixture(params=[PLAIN, SPLIT], ids=["plain", "split"])
def policy(request):
    return request.param
