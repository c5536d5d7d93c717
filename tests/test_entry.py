"""The library without its optional folders."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("pipeline_too", [True, False])
def test_imports_without_the_optional_folders(tmp_path, pipeline_too):
    """All other queries and their SQL are there, whether or not the pipeline's file goes too."""
    left_out = ["llm", ".git", "__pycache__", *(["corpus_pipeline.py"] if pipeline_too else [])]
    shutil.copytree(ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns(*left_out))
    code = (
        "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert q.keys() == s.keys(); "
        "assert not any(n.startswith('op') or n == 'pipeline' for n in q); import check, bench; print(len(q))"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) >= 94
