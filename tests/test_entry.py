"""The driver's entry with and without the optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SAY = "import __spark_entry__ as e; print('NAMES', *sorted(e.queries()))"


@pytest.fixture
def copied(tmp_path):
    shutil.copytree(ROOT / "reachmap", tmp_path / "reachmap", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    return tmp_path


def said(folder):
    return subprocess.run([sys.executable, "-c", SAY], cwd=folder, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(folder)})


def test_entry_without_the_subpackage(copied):
    for _ in range(2):
        out = said(copied)
        assert out.returncode == 0, out.stderr
        assert "q12_area_atlas" in out.stdout and " op" not in out.stdout and "pipeline" not in out.stdout.split()
        (copied / "reachmap" / "llm").mkdir(exist_ok=True)  # an empty folder is no subpackage either


def test_a_broken_subpackage_is_not_hidden(copied):
    (copied / "reachmap" / "llm").mkdir()
    (copied / "reachmap" / "llm" / "__init__.py").touch()
    (copied / "reachmap" / "llm" / "queries.py").write_text("import a_module_that_is_missing\n")
    out = said(copied)
    assert out.returncode != 0 and "a_module_that_is_missing" in out.stderr
