"""The library and its entry work where the training-data operators are not there."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_the_subpackage(tmp_path):
    shutil.copytree(f"{REPO}/batchloom", tmp_path / "batchloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "batchloom" / "llm" / "__pycache__").mkdir(parents=True)  # a left-over folder that cannot be imported from
    shutil.copy(f"{REPO}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert len(q) > 50 and set(q) == set(o) and 'pipeline' not in q"
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert run.returncode == 0, run.stderr


def test_nothing_else_imports_the_subpackage():
    for folder, _, files in os.walk(f"{REPO}/batchloom"):
        if "llm" not in folder.split(os.sep):
            for name in files:
                if name.endswith(".py"):
                    with open(f"{folder}/{name}") as f:
                        assert "batchloom.llm" not in f.read(), name
