"""Every registered query of the library proper against its SQL twin on the smallest tables."""

import os
import subprocess
import sys

import pytest
from check_queries import compare, connect

import __spark_entry__ as entry
from rankflow.plans.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(n for n, q in REGISTRY.items() if q.sql is not None))
def test_query(spark, connection, name):
    assert compare(spark, connection, FOLDER, name).startswith("ok")


def test_flagship(spark):
    assert entry.entry(spark).count() == 20


def test_every_query_has_a_twin():
    assert all(query.sql for query in REGISTRY.values())


@pytest.mark.parametrize("blocked", ["xxhash", "sentencepiece", "zstandard", "rankflow.llm", "corpus_pipeline"])
def test_entry_without_what_the_training_data_side_needs(blocked):
    """A missing folder or dependency takes its own queries away, and no other."""
    code = f"""
import sys
sys.modules[{blocked!r}] = None
import __spark_entry__ as entry
from rankflow.plans.queries import REGISTRY
assert set(entry.queries()) == set(REGISTRY) and set(entry.oracle_sql()) == set(REGISTRY)
"""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
