"""Graph-job invariants (undirected order, unique edges, weight = set size, endpoints
have nodes, header matches rows) on the smoke tables."""

import pytest
from pyspark.sql import functions as F

from linkgraph.plans import jobs as J
from linkgraph.session import scratch_path
from linkgraph.sources import sinks as K
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def graph(spark):
    names = ("lineitem", "orders", "supplier", "customer", "nation")
    tables = {n: spark.read.parquet(f"{SF_SMALL}/{n}.parquet") for n in names}
    return J.whole_graph(tables)


def test_undirected_edges_are_ordered_and_unique(graph):
    e = graph.relationships["bought_with"].edges
    assert e.where(F.col("NodeID1") <= F.col("NodeID2")).count() == 0
    assert e.count() == e.select("NodeID1", "NodeID2").distinct().count()


def test_weight_equals_set_size_when_weight_column_is_a_set(graph):
    for name, col in (("bought_with", "EdgeID_att"), ("supplies", "l_orderkey_att"), ("based_in", "EdgeID_att")):
        e = graph.relationships[name].edges
        n = F.size(F.split(F.regexp_replace(col, r"^\[|\]$", ""), ", "))
        assert e.where(n != F.col("edge_weight")).count() == 0, name


def test_min_edges_and_bipartite_weight(graph):
    assert graph.relationships["supplies"].edges.where("edge_weight < 2").count() == 0
    assert {r.edge_weight for r in graph.relationships["based_in"].edges.collect()} == {1}


def test_every_endpoint_has_a_node(graph):
    for name, g in graph.relationships.items():
        ids = g.nodes.select("NodeID").distinct()
        for side in ("NodeID1", "NodeID2"):
            missing = g.edges.select(F.col(side).alias("NodeID")).distinct().join(ids, "NodeID", "left_anti")
            assert missing.count() == 0, (name, side)


def test_export_headers_match_rows(spark, graph):
    base = scratch_path(spark, "t-jobs")
    written = J.export_graph(graph, base)
    assert {w["name"] for w in written} == {"supplies", "bought_with", "based_in", "Customer", "Nation",
                                           "Part", "Supplier"}
    for w in written:
        header = spark.read.text(w["header"]).first().value
        n = len(header.split("|"))
        back = K.read_export(spark, w)
        assert len(back.columns) == n
        # no value in these tables holds the separator, so every line splits into n fields
        fields = spark.read.text(w["data"]).select(F.size(F.split("value", r"\|")).alias("k"))
        assert {r.k for r in fields.distinct().collect()} <= {n}
    summary = {(r.kind, r.name): r.n_rows for r in J.graph_summary(graph).collect()}
    manifest = {(r.kind, r.name): r.row_count for r in K.import_manifest(spark, written, base).collect()}
    for k in ("supplies", "bought_with", "based_in"):
        assert summary[("relationship", k)] == manifest[("relationship", k)]


def test_export_shapes_match_the_original_samples(spark, graph):
    """Header shapes of the original's sample outputs: membership edges
    `NodeID1:START_ID|NodeID2:END_ID|edge_weight|EdgeID_att` with weight always 1,
    node files `:LABEL|<LABEL>:ID|NodeName`."""
    base = scratch_path(spark, "t-shapes")
    written = {w["name"]: w for w in J.export_graph(graph, base)}
    header = lambda name: spark.read.text(written[name]["header"]).first().value
    assert header("based_in") == "NodeID1:START_ID|NodeID2:END_ID|edge_weight|EdgeID_att"
    assert {r.edge_weight for r in K.read_export(spark, written["based_in"]).collect()} == {"1"}
    assert header("Nation") == ":LABEL|NATION:ID|NodeName"
    assert header("Supplier") == ":LABEL|SUPPLIER:ID|NodeName"
    assert header("Part") == ":LABEL|PART:ID"  # part nodes carry no name: the all-NULL column is dropped
