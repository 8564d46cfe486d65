"""The driver contract holds where the training-data subpackage is gone."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; q = e.queries(); print(len(q), len(e.oracle_sql()), 'pipeline' in q)"


@pytest.mark.parametrize("pipeline_file", [True, False])
def test_entry_imports_without_the_training_data_folders(tmp_path, pipeline_file):
    copy = tmp_path / "repo"
    shutil.copytree(os.path.join(ROOT, "gridwave"), copy / "gridwave",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py", "corpus_pipeline.py"][:1 + pipeline_file]:
        if os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), copy / name)
    out = subprocess.run([sys.executable, "-c", COUNT], cwd=copy, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr
    from gridwave.plans.catalog import REGISTRY
    from gridwave.plans.oracle import SQL
    assert out.stdout.split() == [str(len(REGISTRY)), str(len(set(SQL) & set(REGISTRY))), "False"]
