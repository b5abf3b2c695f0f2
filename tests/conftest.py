from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="quarry-tests-")
    s = build_session(
        "local[*]",
        app_name="quarry-tests",
        shuffle_partitions=8,
        extra={"spark.checkpoint.dir": os.path.join(scratch, "checkpoints")},
    )
    yield s
    s.stop()


@pytest.fixture
def write_files(tmp_path):
    """Write ``{name: text}`` into a fresh folder and return its path."""

    def _write(files: dict[str, str], sub: str = "in") -> str:
        d = tmp_path / sub
        d.mkdir(parents=True, exist_ok=True)
        for name, text in files.items():
            (d / name).write_bytes(text.encode("utf-8"))
        return str(d)

    return _write


def rows(df, *cols):
    """Sorted tuples of the given (or all) columns."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
