"""The library without its training-data operators."""

import os
import shutil
import subprocess
import sys
from pathlib import Path


def test_entry_without_the_llm_folders(tmp_path):
    root = Path(__file__).resolve().parents[1]
    for name in ("screenwell", "workload"):
        shutil.copytree(root / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; n = e.queries(); assert len(n) > 100 and 'pipeline' not in n and set(e.oracle_sql()) <= set(n)"
    for with_pipeline in (False, True):
        if with_pipeline and (root / "corpus_pipeline.py").exists():
            shutil.copy(root / "corpus_pipeline.py", tmp_path)
        done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                              env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": str(tmp_path)})
        assert done.returncode == 0, done.stderr
