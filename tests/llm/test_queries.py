"""Queries with SQL against it, and the entry with and without this subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__
from amendry.llm.queries import ORACLES, REGISTRY
from tests.compare import connect, difference

ROOT = Path(__spark_entry__.__file__).parent


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, sf, name):
    assert difference(spark, con, name, REGISTRY[name], ORACLES[name], sf) is None


def test_all_are_registered():
    assert {*REGISTRY, "pipeline"} <= set(__spark_entry__.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY) == list(range(1, 14))


def test_entry_works_without_this_subpackage(tmp_path):
    for name in ("amendry", "oracles", "__spark_entry__.py"):
        source = ROOT / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; print(len(e.queries()), any(q.startswith('op') and q[2].isdigit() for q in e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"})
    assert done.stdout.split()[-1:] == ["False"], done.stderr
