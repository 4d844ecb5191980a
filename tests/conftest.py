from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TESTS = os.path.join(ROOT, "tests")
sys.path.insert(0, ROOT)
# Python workers unpickle functions defined in test modules by module name.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [ROOT, TESTS] + [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from corpusmill.session import build_session, checkpoint_root

    s = build_session(app="corpusmill-tests", master="local[*]", shuffle_partitions=8, driver_memory="8g")
    checkpoint_root(s)  # unset in tests: a folder of our own
    yield s
    s.stop()


@pytest.fixture
def write(tmp_path):
    """Write text or bytes under ``tmp_path``; returns the full path."""

    def _write(name: str, content: str | bytes) -> str:
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        if isinstance(content, bytes):
            p.write_bytes(content)
        else:
            p.write_text(content, encoding="utf-8")
        return str(p)

    return _write


def rows(df, *cols, order=None):
    """Collected rows as tuples, optionally sorted by ``order`` columns."""
    if order:
        df = df.orderBy(*order)
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
