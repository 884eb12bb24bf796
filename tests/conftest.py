import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lakeward.session import build_session

    s = build_session("local[4]", 4, app="lakeward-tests")
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="lakeward-test-")


def plain_sessions(rows, gap=1800):
    """event_id -> session number per user: a pause above ``gap`` whole seconds begins a new one."""
    out, by_user = {}, {}
    for user, ts, event in rows:
        by_user.setdefault(user, []).append((ts.replace(microsecond=0), ts, event))
    for own in by_user.values():
        own.sort(key=lambda x: x[1])
        number, before = 0, own[0][0]
        for second, _, event in own:
            number += (second - before).total_seconds() > gap
            out[event], before = number, second
    return out
