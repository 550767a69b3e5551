"""The entry file without the optional part."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = "import __spark_entry__ as e; assert len(e.queries()) > 200 and not any(n.startswith('op1_') for n in e.queries()); e.oracle_sql()"


@pytest.mark.parametrize("leftover", [False, True])
def test_other_queries_load_without_the_optional_part(tmp_path, leftover):
    copy = tmp_path / "repo"
    ignore = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", "spark-warehouse", "tests")
    shutil.copytree(ROOT, copy, ignore=ignore)
    if leftover:
        (copy / "tablecraft" / "llm").mkdir()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", CODE], cwd=copy, env=env, check=True, timeout=120)
