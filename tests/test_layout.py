"""The library without its training-data operators."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
SCRIPT = """
import __spark_entry__ as e
assert e.llm is None and e.corpus_pipeline is None
names = e.queries()
assert "bm25_rank" in names and not any(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in names) and set(e.oracle_sql()) <= set(names)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
assert e.entry(spark).count() > 0
"""


def test_the_rest_works_with_both_folders_gone(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", ".pytest_cache"))
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, env=os.environ | {"PYTHONPATH": str(copy)}, capture_output=True, text=True, timeout=300, check=False)
    assert done.returncode == 0, done.stderr[-2000:]


def test_a_broken_operator_module_is_an_error(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "tests"))
    if not (copy / "plinth" / "llm").is_dir():
        return
    (copy / "plinth" / "llm" / "queries.py").write_text("import no_such_module")
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=copy, env=os.environ | {"PYTHONPATH": str(copy)}, capture_output=True, text=True, timeout=100, check=False)
    assert done.returncode != 0 and "no_such_module" in done.stderr
