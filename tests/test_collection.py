"""The whole tree of tests can be collected together."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

HERE = Path(__file__).resolve().parent


def test_all_modules_collect_together():
    got = subprocess.run(
        [sys.executable, "-m", "pytest", "--collect-only", "-q", str(HERE)],
        capture_output=True, text=True, cwd=HERE.parent, timeout=300, check=False,
    )
    assert got.returncode == 0, got.stdout[-2000:]
    for module in HERE.rglob("test_*.py"):
        assert f"{module.relative_to(HERE.parent)}::" in got.stdout, module


def test_nothing_imports_from_a_conftest():
    words = ("from " + "conftest", "import " + "conftest")
    for module in HERE.rglob("*.py"):
        assert not any(w in module.read_text() for w in words), module
