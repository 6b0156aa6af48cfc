"""The driver's file without the training-data operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_the_rest_works_without_the_training_data_operators(tmp_path):
    """Both folders and the pipeline are left out of a copy; its other queries are all there and one runs."""
    copy = tmp_path / "repo"
    skip = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", "spark-warehouse", "*.json")
    shutil.copytree(ROOT, copy, ignore=skip)
    code = (
        "import __spark_entry__ as e; from martloom.queries import QUERIES; from martloom.session import local_session;"
        "assert set(e.queries()) == set(QUERIES) and 'pipeline' not in e.oracle_sql();"
        "spark = local_session('rest', cpus=2, memory='1g');"
        "print('rows', e.queries()['row_sequence'](spark, '/root/testdata/sf0.001').count())"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "rows" in done.stdout
