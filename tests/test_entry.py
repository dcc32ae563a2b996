"""The entry points work without the operators for training data."""

import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).parent.parent


def test_entry_without_the_optional_parts(tmp_path):
    shutil.copytree(REPO / "vuelometria", tmp_path / "vuelometria", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    (tmp_path / "vuelometria/llm/__pycache__").mkdir(parents=True)  # what a deleted folder may leave behind
    code = "import __spark_entry__ as e; print(sorted(k for k in e.queries() if k[:2] == 'op' or k == 'pipeline'), len(e.oracle_sql()) > 100)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.stdout.strip() == "[] True", out.stderr[-500:]


def test_nothing_else_imports_them():
    for path in (REPO / "vuelometria").rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(encoding="utf-8"), path
