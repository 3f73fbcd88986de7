"""The library without its training-data subpackage, as a copy without those folders."""

import shutil
import subprocess
import sys

from tests.conftest import ROOT, SF

CODE = f"""
import sys
import __spark_entry__ as e, bench, tickforge.cli, tickforge.queries as q
assert set(e.queries()) == set(q.QUERIES) and set(e.oracle_sql()) == set(q.ORACLES) and len(q.QUERIES) > 45
assert not [m for m in sys.modules if m.startswith(("tickforge.llm", "corpus_pipeline"))]
from tickforge.session import local
assert e.queries()["bars_1h"](local("2", 2), {SF!r}).count() > 0
"""


def test_without_the_subpackage(tmp_path):
    here = tmp_path / "copy"
    left_out = shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py", ".pytest_cache", "spark-warehouse")
    shutil.copytree(ROOT, here, ignore=left_out)
    assert not list(here.rglob("llm")) and not (here / "corpus_pipeline.py").exists()
    subprocess.run([sys.executable, "-c", CODE], cwd=here, check=True, timeout=300, env={"PATH": __import__("os").environ["PATH"], "PYTHONPATH": str(here), "HOME": str(tmp_path)})
    collected = subprocess.run([sys.executable, "-m", "pytest", "tests", "--collect-only", "-q"], cwd=here, timeout=300, capture_output=True, text=True)
    assert collected.returncode == 0, collected.stdout[-2000:]
