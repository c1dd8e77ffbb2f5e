"""Readers, line policies, state formats and sinks."""

import glob
import os

import pytest
from conftest import as_dict
from pyspark.sql import functions as F

from rankflow import run
from rankflow.functions.text import restart_scores, score_rows
from rankflow.operators import graph
from rankflow.session import ensure_checkpoint_dir, scoped_conf
from rankflow.sources import edges as edge_source
from rankflow.sources import ranks as rank_source
from rankflow.sources import runs as run_source
from rankflow.sources import state as state_source
from rankflow.sources.files import Files, merge_parts
from rankflow.sources.paths import to_uri

LINES = [
    "a\tb", "# c\td", "#e\tf", "", "   ", "x", "\ta\tb", "a\t\tb", "a\tb\t9", " g \t h ", "i\tj\r",
    "　k\tl\xa0",
]


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame([(line,) for line in LINES], "value STRING")


def parsed(frame):
    return sorted(tuple(row) for row in frame.collect())


def test_core_policy(lines):
    assert parsed(edge_source.parse_edges(lines, "core")) == sorted(
        [("a", "b"), ("a", "b"), ("a", ""), ("a", "b"), ("g", "h"), ("i", "j"), ("k", "l")]
    )


def test_first2_policy(lines):
    assert parsed(edge_source.parse_edges(lines, "first2")) == sorted(
        [("a", "b"), ("# c", "d"), ("#e", "f"), ("a", "b"), ("a", ""), ("a", "b"), ("g ", " h"),
         ("i", "j"), ("k", "l")]
    )


def test_exact2_policies(lines):
    assert parsed(edge_source.parse_edges(lines, "exact2")) == sorted(
        [("a", "b"), ("# c", "d"), ("#e", "f"), ("a", "b"), ("g ", " h"), ("i", "j"), ("k", "l")]
    )
    # this policy trims control characters and plain spaces only
    assert parsed(edge_source.parse_edges(lines, "exact2_nocomment")) == sorted(
        [("a", "b"), ("a", "b"), ("g", "h"), ("i", "j"), ("　k", "l\xa0")]
    )


def test_unknown_policy(lines):
    with pytest.raises(ValueError, match="policy"):
        edge_source.parse_edges(lines, "loose")


def test_weighted_lines(spark):
    good = ["a\tb\t1.5", "a\tb", "b\tc\t 2e1 ", "c\td\t.5\textra"]
    frame = spark.createDataFrame([(line,) for line in good], "value STRING")
    edges = edge_source.parse_edges(frame, "core", weighted=True)
    assert parsed(edges) == [("a", "b", 1.5), ("b", "c", 20.0), ("c", "d", 0.5)]
    bad = frame.union(spark.createDataFrame([("a\tb\tx",), ("a\tb\t1d",)], "value STRING"))
    with pytest.raises(Exception, match="not a number"):
        edge_source.parse_edges(bad, "core", weighted=True).collect()
    lenient = edge_source.parse_edges(bad, "core", weighted=True, on_bad_weight="skip")
    assert lenient.count() == 3


def test_read_edges_from_file(spark, tmp_path):
    path = tmp_path / "edges.txt"
    path.write_text("# header\n1\t2\n2\t1\n\n3\n", encoding="utf-8")
    assert parsed(edge_source.read_edges(spark, str(path))) == [("1", "2"), ("2", "1")]


def test_edge_table_drops_nulls(spark, tmp_path):
    path = tmp_path / "edges.tsv"
    path.write_text("a\tb\n\tc\nd\t\ne\nf\tg\n", encoding="utf-8")
    assert parsed(edge_source.read_edge_table(spark, str(path))) == [("a", "b"), ("f", "g")]


def test_edges_round_trip(spark, tmp_path, ring_weighted):
    path = str(tmp_path / "edges")
    edge_source.write_edges(ring_weighted, path)
    back = edge_source.read_edges(spark, path, weighted=True)
    assert parsed(back) == parsed(ring_weighted)
    assert parsed(edge_source.read_edge_table(spark, path, weighted=True)) == parsed(ring_weighted)


def test_to_uri(tmp_path):
    assert to_uri("hdfs://host/a") == "hdfs://host/a"
    assert to_uri("file:///a") == "file:///a"
    assert to_uri("file:/a/b") == "file:/a/b"
    assert to_uri("data/x.txt") == "file://" + os.path.abspath("data/x.txt")


@pytest.mark.parametrize("style", ["pipe", "tsv", "json"])
def test_state_round_trip(spark, tmp_path, leaky, style):
    nodes = graph.node_set(leaky).withColumn("rank", F.lit(0.125))
    state = graph.adjacency(leaky, ranks=nodes).drop("block")
    path = str(tmp_path / style)
    state_source.write_state(state, path, style)
    back = state_source.read_state(spark, path, style)
    assert parsed(back) == parsed(state)
    assert parsed(state_source.edges_from_state(back)) == parsed(leaky)


def test_json_state_keeps_odd_names(spark):
    rows = [('q"u\\oé', 1e-05, ['x"y', "z,w", ""]), ("t", 0.5, [])]
    state = spark.createDataFrame(rows, "node STRING, rank DOUBLE, neighbors ARRAY<STRING>")
    text = state_source.format_json(state)
    assert "\t[0.5, []]" in [r["value"][3:] for r in text.collect()]
    assert parsed(state_source.parse_json(text)) == parsed(state)


def test_pipe_state_lines(spark):
    raw = ["a\t0.5|b,c", "b\t0.25|", "c\t0.1", "# x\t1|y", "d\t1|e\tf", "lonely", ""]
    frame = spark.createDataFrame([(line,) for line in raw], "value STRING")
    exact = parsed(state_source.parse_pipe(frame))
    assert exact == [("# x", 1.0, ["y"]), ("a", 0.5, ["b", "c"]), ("b", 0.25, [])]
    loose = parsed(state_source.parse_pipe(frame, exact=False, skip_comments=True))
    assert [row[0] for row in loose] == ["a", "b", "d"]
    ranks = as_dict(state_source.parse_pipe_ranks(frame))
    assert ranks == {"a": 0.5, "b": 0.25, "c": 0.1, "d": 1.0}


def test_pipe_state_has_eight_decimals(spark):
    state = spark.createDataFrame([("a", 1 / 3, ["b"])], "node STRING, rank DOUBLE, neighbors ARRAY<STRING>")
    assert state_source.format_pipe(state).first()[0] == "a\t0.33333333|b"


def test_rank_sinks(spark, tmp_path, ring):
    ranks = run(ring).ranks
    parts, text, table = (str(tmp_path / name) for name in ("parts", "text", "table"))
    rank_source.write_ranking(ranks, parts)
    rank_source.write_rank_text(ranks, text)
    rank_source.write_rank_table(ranks, table)
    rank_source.write_rank_table(ranks, table)
    exact = as_dict(ranks)
    for path, tolerance in ((parts, 6e-9), (text, 6e-9), (table, 1e-17)):
        back = as_dict(rank_source.read_ranks(spark, path))
        assert back.keys() == exact.keys()
        assert max(abs(back[n] - exact[n]) for n in exact) <= tolerance
    with pytest.raises(Exception, match="exist"):
        rank_source.write_rank_text(ranks, text)


def test_ranking_parts_hold_ranges(tmp_path, ring):
    path = str(tmp_path / "ranking")
    rank_source.write_ranking(run(ring).ranks, path)
    text = []
    for part in sorted(glob.glob(path + "/part-*")):
        with open(part, encoding="utf-8") as file:
            text += file.read().splitlines()
    rows = [line for line in text if line != "node\trank"]
    assert rows[:2] == ["1\t0.17582556", "3\t0.16908249"]
    assert len(rows) == 10


@pytest.mark.parametrize("write", ["write_ranking", "write_rank_text", "write_rank_table"])
def test_every_id_comes_back(spark, tmp_path, write):
    ids = ["", "node", "rank", '""', 'a"b', " spaced ", "é"]
    ranks = spark.createDataFrame([(x, 1.0 / (i + 2)) for i, x in enumerate(ids)], "node string, rank double")
    path = str(tmp_path / "ids")
    getattr(rank_source, write)(ranks, path)
    assert sorted(r["node"] for r in rank_source.read_ranks(spark, path).collect()) == sorted(ids)


def test_sizes_over_two_to_the_31(spark):
    names = run_source.COLUMNS
    row = dict.fromkeys(names, "1") | {"n_nodes": "3000000000", "n_edges": "9000000000", "status": "ok"}
    raw = spark.createDataFrame([tuple(row[n] for n in names)], ", ".join(f"{n} string" for n in names))
    (got,) = run_source.usable_runs(raw).collect()
    assert (got["n_nodes"], got["n_edges"]) == (3_000_000_000, 9_000_000_000)


def test_edges_without_an_endpoint_are_not_written(spark, tmp_path):
    edges = spark.createDataFrame([(None, "b", 1.0), ("a", "b", 2.0)], "src string, dst string, w double")
    edge_source.write_edges(edges, str(tmp_path / "edges"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "edges")).collect()] == ["a\tb\t2.0"]


def test_run_measurements(spark, tmp_path):
    path = tmp_path / "runs.csv"
    path.write_text(
        ",".join(run_source.COLUMNS) + "\n"
        "x,X,1000,3386,0.5,0.1,13.6,0.1,3,30,5e-09,ok\n"
        "x,X,5000,17015,1.5,,,,1,30,0,ok\n"
        "y,Y,1000,3386,,,,,,,,error\n"
        "y,Y,abc,3386,1.0,0,1,0,1,30,,ok\n"
        "y,Y,1000,3386,1.0,0,none,0,1,30,,ok\n",
        encoding="utf-8",
    )
    runs = run_source.read_runs(spark, str(path)).orderBy("n_nodes").collect()
    assert [(r["n_nodes"], r["time_s"], r["time_s_std"], r["peak_mem_mb"], r["max_diff_vs_core"]) for r in runs] == [
        (1000, 0.5, 0.1, 13.6, 5e-09),
        (5000, 1.5, 0.0, None, 0.0),
    ]
    out = str(tmp_path / "out")
    frame = run_source.read_runs(spark, str(path))
    run_source.append_runs(frame, out)
    run_source.append_runs(frame, out)
    assert run_source.read_runs(spark, out).count() == 4


def test_restart_scores():
    assert restart_scores(["a=1", " b =2.5", "a=3", "=4"]) == {"a": 3.0, "b": 2.5, "": 4.0}
    assert restart_scores([]) == {}
    for bad in (["a"], ["a=1", ""], ["a=b=1"], ["a="]):
        with pytest.raises(ValueError):
            restart_scores(bad)


def test_score_lines(spark):
    lines = spark.createDataFrame([(x,) for x in ("a=1", " b =2.5", "", "a=3", "=4")], "value STRING").coalesce(1)
    assert {r["node"]: r["score"] for r in score_rows(lines).collect()} == {"a": 3.0, "b": 2.5, "": 4.0}
    for bad in ("a", "a=b", "a="):
        with pytest.raises(Exception, match="no score|not a number"):
            score_rows(spark.createDataFrame([(bad,)], "value STRING")).collect()


def test_relation_without_quoting(spark, tmp_path):
    rows = ['"a\tb"', "# c\t d ", "e\t", "\tf", "g", "", "h\ti\tj", '""\t"', "k\t\tl"]
    (tmp_path / "r.txt").write_text("\n".join(rows) + "\n", encoding="utf-8")
    got = [tuple(r) for r in edge_source.read_relation(spark, str(tmp_path / "r.txt")).collect()]
    assert sorted(got) == sorted([('"a', 'b"'), ("# c", " d "), ("h", "i"), ('""', '"')])
    three = edge_source.parse_relation(spark.createDataFrame([("a|b||d",)], "value STRING"), ("x", "y", "z"), "|")
    assert tuple(three.first()) == ("a", "b", None)


def test_merged_ranking_is_one_ordered_file(spark, tmp_path):
    ranks = spark.range(5000).selectExpr("concat('n', id) AS node", "double(id % 700) / 3e3 AS rank").repartition(7)
    path = str(tmp_path / "ranking.tsv")
    assert rank_source.write_ranking_file(ranks, path) in ("concat", "append")
    want = sorted(ranks.collect(), key=lambda r: (-r["rank"], r["node"]))
    lines = "".join(f"{r['node']}\t{r['rank']:.8f}\n" for r in want)
    assert (tmp_path / "ranking.tsv").read_bytes() == b"node\trank\n" + lines.encode()
    assert [n for n in sorted(os.listdir(tmp_path)) if not n.startswith(".")] == ["ranking.tsv"]
    assert rank_source.read_ranks(spark, path).count() == 5000
    with pytest.raises(FileExistsError):
        rank_source.write_ranking_file(ranks, path)


def test_merged_parts_keep_their_bytes(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    for name, text in (("part-1", b"b\n"), ("part-0", b"a\r\n\xc3\xa9"), ("part-2", b""), ("_SUCCESS", b"x"), (".part-0.crc", b"y")):
        (folder / name).write_bytes(text)
    merge_parts(spark, str(folder), str(tmp_path / "one"))
    assert (tmp_path / "one").read_bytes() == b"a\r\n\xc3\xa9b\n" and not folder.exists()
    folder.mkdir()
    merge_parts(spark, str(folder), str(tmp_path / "none"))
    assert (tmp_path / "none").read_bytes() == b""


class _Concat:
    """A file system that can join files in place."""

    def __init__(self, real):
        self.real, self.calls = real, []

    def __getattr__(self, name):
        return getattr(self.real, name)

    def concat(self, first, rest):
        self.calls.append([p.getName() for p in rest])
        with open(first.toUri().getPath(), "ab") as out:
            for part in rest:
                with open(part.toUri().getPath(), "rb") as data:
                    out.write(data.read())
                os.remove(part.toUri().getPath())


def test_file_systems_that_join_in_place(spark, tmp_path):
    for name in ("p0", "p1", "p2"):
        (tmp_path / name).write_bytes(name.encode())
    files = Files(spark, str(tmp_path))
    files._system = _Concat(files._system)
    assert files.joined([str(tmp_path / n) for n in ("p0", "p1", "p2")], str(tmp_path / "all")) == "concat"
    assert files._system.calls == [["p1", "p2"]]
    assert (tmp_path / "all").read_bytes() == b"p0p1p2"


def test_merged_state_file(spark, tmp_path):
    rows = [(f"n{i:03d}", i / 64, [f"n{i + 1:03d}"]) for i in range(300)]
    state = spark.createDataFrame(rows, "node STRING, rank DOUBLE, neighbors ARRAY<STRING>").repartition(5)
    state_source.write_state_file(state, str(tmp_path / "state"), "tsv")
    back = state_source.read_state(spark, str(tmp_path / "state"), "tsv")
    assert [r["node"] for r in back.collect()] == [r[0] for r in rows]


class _Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, context, configured=None):
        self.sparkContext, self.configured = context, configured
        self.conf = self

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.configured or default


def test_checkpoint_folder_choice():
    kept = _Context("yarn", "hdfs://set/before")
    ensure_checkpoint_dir(_Session(kept, "hdfs://named"))
    assert kept.folder == "hdfs://set/before"
    named = _Context("yarn")
    ensure_checkpoint_dir(_Session(named, "hdfs://named"))
    assert named.folder == "hdfs://named"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session(_Context("yarn")))
    local = _Context("local[2]")
    ensure_checkpoint_dir(_Session(local))
    assert "rankflow-" in local.folder


@pytest.mark.parametrize("style", ["pipe", "tsv", "json"])
def test_state_keeps_the_empty_id(spark, tmp_path, style):
    rows = [("", 0.5, ["a"]), ("a", 0.25, ["", "node"]), ("node", 0.25, []), (" b ", 0.125, ["a"])]
    state = spark.createDataFrame(rows, "node STRING, rank DOUBLE, neighbors ARRAY<STRING>")
    state_source.write_state(state, str(tmp_path / style), style)
    assert parsed(state_source.read_state(spark, str(tmp_path / style), style)) == parsed(state)


def test_blocks_of_a_hub_stay_spread(spark, tmp_path, make_edges):
    edges = make_edges([("hub", f"n{i}") for i in range(600)] + [("a", "b")])
    ranks = graph.node_set(edges).withColumn("rank", F.lit(0.125))
    state = graph.adjacency(edges, block_size=10, min_hot_degree=100, ranks=ranks)
    path = str(tmp_path / "state")
    with scoped_conf(spark, {"spark.sql.adaptive.enabled": "false"}):  # it would merge small partitions
        hub = state.where("node = 'hub'").withColumn("part", F.spark_partition_id())
        assert hub.select("part").distinct().count() > 1
        state_source.write_state(state.where("node = 'hub'"), path)
    back = state_source.read_state(spark, path)
    assert back.select(F.input_file_name()).distinct().count() > 1
    assert back.select(F.explode("neighbors")).count() == 600
