"""The entry without the optional parts."""

import os
import shutil
import subprocess
import sys

import pytest

from orderloom.catalog import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PRINT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"


@pytest.mark.parametrize("gone", [["orderloom/llm", "tests/llm"], ["orderloom/llm", "tests/llm", "corpus_pipeline.py"]])
def test_entry_without_the_optional_package(tmp_path, gone):
    left = shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", *[os.path.basename(g) for g in gone])
    copy = shutil.copytree(ROOT, tmp_path / "copy", ignore=left)
    assert not any((copy / g).exists() for g in gone)
    found = subprocess.run([sys.executable, "-c", PRINT], cwd=copy, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(copy)}, check=False)
    assert found.stdout.split() == [str(len(QUERIES)), str(len(QUERIES)), "False"], found.stderr
