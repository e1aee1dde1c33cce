"""The entry module works without the optional subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _copy(tmp_path, pipeline):
    shutil.copytree(os.path.join(ROOT, "arcloom"), tmp_path / "arcloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", *(("corpus_pipeline.py",) if pipeline else ())):
        shutil.copy(os.path.join(ROOT, name), tmp_path)


@pytest.mark.parametrize("pipeline", [False, True])
def test_without_optional_parts(tmp_path, pipeline):
    """Both folders are gone; the pipeline's module may stay behind or go with them."""
    if pipeline and not os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")):
        pytest.skip("no pipeline")
    _copy(tmp_path, pipeline)
    code = """import os
import __spark_entry__ as e
q = e.queries()
assert 'pipeline' not in q and not any(x.startswith('op') for x in q) and set(e.oracle_sql()) <= set(q)
data = '/root/testdata/sf0.001'
if os.path.isdir(data):
    from pyspark.sql import SparkSession
    spark = SparkSession.builder.master('local[2]').config('spark.sql.shuffle.partitions', '2').config('spark.ui.enabled', 'false').getOrCreate()
    assert q['strict_group'](spark, data).count()
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=240, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert out.returncode == 0, out.stderr


def test_nothing_imports_the_optional_package():
    for folder, _, names in os.walk(os.path.join(ROOT, "arcloom")):
        if "llm" in folder.split(os.sep):
            continue
        for name in names:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as f:
                    assert "arcloom.llm" not in f.read(), name
