"""Every retail query against its checking SQL on the smallest data folder, and the driver's entry."""

import importlib.util
import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from compare import check_engine, difference
from oracle.statements import statements
from tillback.registry import all_queries

FOLDER = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.abspath(entry.__file__))
QUERIES, STATEMENTS = all_queries(), statements()


@pytest.fixture(scope="module")
def engine():
    return check_engine(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, engine, name):
    df = QUERIES[name](spark, FOLDER)
    if name in STATEMENTS:
        assert difference(df, engine, STATEMENTS[name]) == ""
    else:
        assert df.count() > 0


def test_every_statement_has_a_query():
    assert set(STATEMENTS) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 200


@pytest.mark.parametrize("without", [("tillback/llm",), ("tillback/llm", "corpus_pipeline.py"), ("corpus_pipeline.py",), ()])
def test_entry_without_the_text_operators(tmp_path, without):
    """A copy of the tree without the text operators still lists every retail query."""
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    for name in without:
        target = copy / name
        shutil.rmtree(target, ignore_errors=True) if target.is_dir() else target.unlink(missing_ok=True)
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"
    run = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert run.returncode == 0, run.stderr
    names = set(run.stdout.split())
    assert set(QUERIES) <= names
    there = importlib.util.find_spec("tillback.llm") is not None
    assert any(name.startswith("op1_") for name in names) == (there and "tillback/llm" not in without)
    assert ("pipeline" in names) == (there and not without)
