"""The driver entry: names, and every oracle has its query."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

REPO = Path(__file__).resolve().parent.parent


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and "profile_flagship" in entry.queries()


def test_entry_without_the_optional_parts(tmp_path):
    for name in ("provena", "__spark_entry__.py"):
        subprocess.run(["cp", "-r", REPO / name, tmp_path], check=True)
    subprocess.run(["rm", "-rf", tmp_path / "provena/llm"], check=True)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries())"], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "HOME": str(tmp_path)}, capture_output=True, text=True)
    assert said.stdout.split()[1:] == ["False"], said.stderr
