import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rankflow.session import local_session  # noqa: E402

# 22 edges over 10 nodes, no dangling node.
RING = (
    "1>2 1>3 2>3 2>4 3>1 3>5 4>5 4>6 5>1 5>4 6>2 6>3 6>4 7>1 7>8 8>7 8>9 9>8 9>10 10>1 10>3 10>9"
)
# 7 edges over 6 nodes; 4 and 6 are dangling.
LEAKY = "1>2 1>3 2>3 2>4 3>1 5>3 5>6"


def pairs(text):
    return [tuple(edge.split(">")) for edge in text.split()]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", os.environ.get("TEST_CPUS", "8"), "4g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_edges(spark):
    def build(edges):
        rows = pairs(edges) if isinstance(edges, str) else list(edges)
        width = len(rows[0]) if rows else 2
        schema = "src STRING, dst STRING" + (", w DOUBLE" if width == 3 else "")
        return spark.createDataFrame(rows, schema)

    return build


@pytest.fixture(scope="session")
def ring(make_edges):
    return make_edges(RING).cache()


@pytest.fixture(scope="session")
def ring_weighted(make_edges):
    rows = [(s, d, float(i % 5 + 1)) for i, (s, d) in enumerate(pairs(RING))]
    return make_edges(rows).cache()


@pytest.fixture(scope="session")
def leaky(make_edges):
    return make_edges(LEAKY).cache()


def as_dict(ranks):
    return {row["node"]: row["rank"] for row in ranks.collect()}


def golden(text):
    return {k: float(v) for k, v in (item.split("=") for item in text.replace(",", " ").split())}


def close(left, right, tolerance=1e-9):
    return left.keys() == right.keys() and all(abs(left[k] - right[k]) < tolerance for k in left)
