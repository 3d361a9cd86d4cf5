"""The registry without the subpackage for training data."""

import json
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
LIST = "import json, warnings; warnings.simplefilter('ignore'); import __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


def listed(folder):
    out = subprocess.run([sys.executable, "-c", LIST], cwd=folder, capture_output=True, text=True, check=True, env={"PATH": "/usr/bin:/bin", "HOME": str(folder)})
    return json.loads(out.stdout.splitlines()[-1])


def test_the_other_queries_stand_without_the_subpackage(tmp_path):
    full, full_sql = listed(ROOT)
    core = [n for n in full if n != "pipeline" and not n.startswith("op")]
    shutil.copytree(ROOT / "tidewatch", tmp_path / "a/tidewatch", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path / "a")
    assert listed(tmp_path / "a")[0] == core  # corpus_pipeline.py is gone too
    shutil.copy(ROOT / "corpus_pipeline.py", tmp_path / "a")
    names, sql = listed(tmp_path / "a")
    assert names == core and sql == [n for n in full_sql if n in core]
