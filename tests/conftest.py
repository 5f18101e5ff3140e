import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from foehn.session import build_session

    s = build_session(
        "local[4]",
        app_name="foehn-tests",
        shuffle_partitions=4,
        extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="foehn-test-ckpt-")},
    )
    yield s
    s.stop()


@pytest.fixture
def landing(tmp_path):
    return tmp_path


def write_file(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return path
