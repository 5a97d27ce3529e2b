"""The entry works without the optional subpackage and without a session."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def imported(folder):
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(s) <= set(q); print(len(q), any(n.startswith('op') for n in q))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True, check=True).stdout.split()


def test_without_the_subpackage(tmp_path):
    shutil.copytree(f"{REPO}/marketloom", tmp_path / "marketloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{REPO}/__spark_entry__.py", tmp_path)
    n, has = imported(tmp_path)
    assert int(n) >= 90 and has == "False"


def test_as_it_is():
    assert int(imported(REPO)[0]) >= 90
