import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from covlens.session import checkpoint_root, get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", shuffle_partitions=8, app_name="covlens-tests")
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)  # sets a local folder only when the session names none
    yield s


def write_lines(path: Path, lines, newline="\n") -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(newline.join(lines) + newline)
    return str(path)
