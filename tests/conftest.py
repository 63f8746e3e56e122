import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tabflow.session import get_spark
    s = get_spark("local[*]", 8, extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("ckpt"))})
    yield s
    s.stop()
