"""The driver contract imports with and without the corpus operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(' '.join(sorted(q)))"


def _queries(folder):
    env = {**os.environ, "PYTHONPATH": os.pathsep.join(p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and os.path.abspath(p) != ROOT)}
    out = subprocess.run([sys.executable, "-c", LIST], cwd=folder, env=env, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return set(out.stdout.split())


@pytest.mark.parametrize("gone", [("corpus_pipeline.py",), ("parcelflow/llm",), ("corpus_pipeline.py", "parcelflow/llm")])
def test_entry_without_the_corpus_folders(tmp_path, gone):
    """Any of the folder and the pipeline file may be missing; all other queries stay."""
    skip = shutil.ignore_patterns("__pycache__", "llm" if "parcelflow/llm" in gone else "__pycache__")
    shutil.copytree(f"{ROOT}/parcelflow", tmp_path / "parcelflow", ignore=skip)
    for f in ("__spark_entry__.py", "corpus_pipeline.py"):
        if f not in gone and os.path.exists(f"{ROOT}/{f}"):
            shutil.copy(f"{ROOT}/{f}", tmp_path / f)
    found = _queries(tmp_path)
    assert {"q01_silver_parcel_events", "r1_stream_ingest_bronze"} <= found and "pipeline" not in found
    assert not any(q.startswith("op") for q in found) or "parcelflow/llm" not in gone
