"""The driver's entry, with and without the optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
PROBE = """
import __spark_entry__ as entry
names = set(entry.queries())
assert set(entry.oracle_sql()) <= names and "actions_rollup" in names, names
print(sorted(n for n in names if n.startswith("op") or n == "pipeline"))
"""


def test_import_without_the_optional_subpackage(tmp_path):
    for leave_pipeline in (True, False):
        copy = tmp_path / f"copy-{leave_pipeline}"
        skip = ["llm", ".git", "__pycache__", "*.pyc"] + ([] if leave_pipeline else ["corpus_pipeline.py"])
        shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(*skip))
        found = subprocess.run([sys.executable, "-c", PROBE], cwd=copy, capture_output=True, text=True, env={"PYTHONPATH": str(copy), "PATH": "/usr/bin:/bin"})
        assert found.returncode == 0, found.stderr
        assert found.stdout.strip() == "[]"
