"""The library without the operators for training text."""

import shutil
import subprocess
import sys
from pathlib import Path

TOP = Path(__file__).resolve().parent.parent
CHECK = """
import sys
import __spark_entry__ as contract
assert "marlstone.llm" not in sys.modules
names = set(contract.queries())
assert "j1_flagged_license_join" in names and "pipeline" not in names
assert not any(n.startswith("op") for n in names) and set(contract.oracle_sql()) <= names
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert contract.entry(spark).count() > 0
import bench, tests.oracle, tests.test_contract
"""


def test_entry_runs_without_the_text_package(tmp_path):
    """With the package and its tests gone; the pipeline's file may still be there, or not."""
    left_out = shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache", "*.json")
    copy = tmp_path / "copy"
    shutil.copytree(TOP, copy, ignore=left_out)
    assert not (copy / "marlstone/llm").exists()
    done = subprocess.run([sys.executable, "-c", CHECK], cwd=copy, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
