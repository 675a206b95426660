"""The entry module without the optional training-data part, and from another working directory."""

import os
import shutil
import subprocess
import sys
import tempfile
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def _names(folder):
    code = f"import importlib.util as u; s = u.spec_from_file_location('e', '{folder}/__spark_entry__.py'); m = u.module_from_spec(s); s.loader.exec_module(m); print(*m.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=tempfile.gettempdir(), capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert out.returncode == 0, out.stderr
    return out.stdout.split()


def test_imports_without_the_optional_part():
    d = Path(tempfile.mkdtemp(prefix="yearloom-entry-"))
    shutil.copytree(ROOT / "yearloom", d / "yearloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", d)
    names = _names(d)
    assert "harmonize_flagship" in names and "pipeline" not in names and not [n for n in names if n.startswith("op")]


def test_imports_from_elsewhere():
    assert "harmonize_flagship" in _names(ROOT)
