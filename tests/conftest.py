import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from pitchlake.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    made = session(
        "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="4g",
        spark__sql__warehouse__dir=f"{folder}/warehouse", spark__local__dir=folder, spark__checkpoint__dir=f"{folder}/checkpoint",
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()
