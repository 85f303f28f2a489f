"""Registration: names, and the rest of the library without this package."""

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry_points

ROOT = Path(__file__).parents[2]


def test_registered():
    names = [n for n in entry_points.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry_points.queries()


def test_rest_works_without_the_package(tmp_path):
    for part in ("lapforge", "testbed", "__spark_entry__.py"):
        source = ROOT / part
        if source.is_dir():
            shutil.copytree(source, tmp_path / part, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / part)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 90 and not any(n.startswith('op') for n in q) and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120, env={"PATH": "/usr/bin:/bin"} | __import__("os").environ | {"PYTHONPATH": ""})
