from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from cairn.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    import __spark_entry__

    s = get_spark("tests", f"local[{os.environ.get('TEST_CPUS', '4')}]", spark__sql__shuffle__partitions="4")
    __spark_entry__._ship(s)
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"
