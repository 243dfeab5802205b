"""Every registered query against its SQL on the small tables."""

import os
import shutil
import subprocess
import sys

import pytest
from compare import check, connect

from plumbline.plans import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, con, name):
    problem, _, _ = check(spark, con, name, QUERIES[name], sf_dir)
    assert problem is None, problem


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_the_training_data_folders(tmp_path, pipeline):
    """The entry and the library's queries stand without plumbline/llm and tests/llm, with or without the pipeline file."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    gone = {"llm", ".git", "__pycache__"} | (set() if pipeline else {"corpus_pipeline.py"})
    shutil.copytree(root, tmp_path / "copy", ignore=lambda _, names: gone & set(names))
    code = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.BASE), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", env={**os.environ, "PYTHONPATH": ""}, capture_output=True, text=True)
    assert said.stdout.split()[0] == "True" and int(said.stdout.split()[1]) > 100, said.stderr
    (tmp_path / "copy/plumbline/llm/__pycache__").mkdir(parents=True)  # caches alone are no subpackage
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", env={**os.environ, "PYTHONPATH": ""}).returncode == 0
