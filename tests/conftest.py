import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from shoplens.session import get_spark

    ckpt = tempfile.mkdtemp(prefix="shoplens-test-ckpt-")
    s = get_spark(app="shoplens-tests", master="local[4]", shuffle_partitions=4,
                  extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from shoplens.session import scratch_dir

    return lambda name="t": scratch_dir(spark, name)


def write_lines(path: str, lines: list[str], name: str = "part.json") -> None:
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")
