import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from regline.session import get_session

    s = get_session("local[4]", shuffle_partitions=8)
    # Tests have no cluster-provided shared folder; give them their own.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="regline-test-"))
    yield s


@pytest.fixture
def write_files(tmp_path):
    """Write {name: bytes} into a fresh folder; returns its path."""

    def _write(files: dict) -> str:
        d = tmp_path / "in"
        d.mkdir(exist_ok=True)
        for name, data in files.items():
            (d / name).write_bytes(data)
        return str(d)

    return _write


def record_line(fields: dict, n: int = 37) -> bytes:
    """A ';' line with the given {position: value}, other positions empty."""
    return ";".join(fields.get(i, "") for i in range(n)).encode("latin-1")


# A company made up for these tests.
GOOD = {0: "40506070", 1: "0002", 2: "11", 3: "19990704", 4: "Padaria do Porto", 5: "1091101",
        7: "05", 10: "S", 13: "N", 14: "08", 15: "20110315", 32: "PE", 29: "50030230"}
