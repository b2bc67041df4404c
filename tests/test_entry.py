"""The rest works on a copy without the optional subpackage."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parent.parent
CODE = """
import sys
import __spark_entry__ as entry
found, sql = entry.queries(), entry.oracle_sql()
assert "synthese_regionale" in found and set(sql) <= set(found), sorted(found)
assert not [n for n in found if n.startswith("op") or n == "pipeline"], sorted(found)
assert not [m for m in sys.modules if m.startswith("limpid.llm") or m == "corpus_pipeline"]
import bench
"""


@pytest.mark.parametrize("pipeline_stays", [True, False])
def test_without_the_subpackage(tmp_path, pipeline_stays):
    skip = shutil.ignore_patterns("llm", "__pycache__", ".git")
    for name in ("limpid", "workload"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=skip)
    for name in ("__spark_entry__.py", "bench.py", "corpus_pipeline.py"):
        if (ROOT / name).exists() and (pipeline_stays or name != "corpus_pipeline.py"):
            shutil.copy(ROOT / name, tmp_path / name)
    (tmp_path / "limpid" / "llm").mkdir()  # a folder left empty is no subpackage
    done = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
