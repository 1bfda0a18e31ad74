import itertools
import random

from pyspark.sql import functions as F

from linkgraph.operators import graph as G
from tests.conftest import rows


def _brute_pairs(data):
    """Reference answer by brute force: distinct (key, left row..., id2, att2) with id1 > id2."""
    out = set()
    for (k1, n1, a1, x1), (k2, n2, a2, _) in itertools.product(data, data):
        if k1 is not None and k1 == k2 and n1 is not None and n2 is not None and n1 > n2:
            out.add((k1, n1, a1, x1, n2, a2))
    return sorted(out)


def _skewed(spark):
    rnd = random.Random(5)
    data = [("hot", rnd.randrange(300), f"n{rnd.randrange(3)}", rnd.randrange(2)) for _ in range(900)]
    data += [(f"k{i % 40}", rnd.randrange(50), "m", 0) for i in range(200)]
    data += [(None, 1, "x", 0), ("k1", None, "x", 0)]
    return data, spark.createDataFrame(data, "EdgeID string, NodeID int, Name string, extra int")


def test_shared_key_pairs_match_brute_force_with_hot_key_split(spark):
    data, df = _skewed(spark)
    expect = _brute_pairs(data)
    hot = G.hot_key_splits(df, "EdgeID", target_parts=8).collect()
    assert [r.EdgeID for r in hot] == ["hot"] and hot[0]["__splits__"] >= 2  # the salted path is exercised
    for split in (True, False):
        out = G.edges_from_shared_key(df, node_att=["Name"], split_hot_keys=split, target_parts=8)
        assert out.columns == ["EdgeID", "NodeID1", "Name1", "extra", "NodeID2", "Name2"]
        got = [tuple(r) for r in out.select("EdgeID", "NodeID1", "Name1", "extra", "NodeID2", "Name2").collect()]
        assert len(got) == len(set(got)) == len(expect)
        assert set(got) == set(expect)


def test_shared_key_without_node_att(spark):
    df = spark.createDataFrame([("e", 3), ("e", 1), ("e", 2), ("f", 1)], "EdgeID string, NodeID int")
    assert rows(G.edges_from_shared_key(df)) == [("e", 2, 1), ("e", 3, 1), ("e", 3, 2)]


def test_threshold_filter(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("a", 2, "x"), ("b", 1, "y"), (None, 1, "z"), (None, 2, "z")],
                               "g string, n int, v string")
    out = G.filter_edges_by_threshold(df, "n", ["g"], 2, 5)
    assert rows(out) == [("a", 1, "x"), ("a", 2, "x")]


def test_edges_agg_sets_weight_dates_and_nodes(spark):
    df = spark.createDataFrame([
        (1, "A", "L", 2, "B", "L", "m1", "x", "2020-01-03"),
        (1, "A", "L", 2, "B", "L", "m2", None, "2020-01-01"),
        (1, "A", "L", 2, "B", "L", "m1", "y", "2020-01-02"),
        (3, "C", "L", 2, "B", "L", "m3", None, "2020-02-01"),
    ], "NodeID1 int, NodeName1 string, Label1 string, NodeID2 int, NodeName2 string, Label2 string, "
       "match string, kind string, day string")
    g = G.edges_agg(df, weight_col="match", col_date="day", min_edges=2, node_att=["NodeName", "Label"])
    assert g.edges.columns == ["NodeID1", "NodeID2", "edge_weight", "match_att", "kind_att", "day_att",
                               "day_min", "day_max"]
    assert rows(g.edges) == [(1, 2, 2, "[m1, m2]", "[x, y]", "[2020-01-01, 2020-01-02, 2020-01-03]",
                              "2020-01-01", "2020-01-03")]
    assert rows(g.nodes) == [(1, "A", "L"), (2, "B", "L")]
    g1 = G.edges_agg(df, weight_col="match", min_edges=1, node_att=["NodeName", "Label"], att_cols=["kind"])
    assert rows(g1.edges.where("NodeID1 = 3")) == [(3, 2, 1, "[]")]


def test_nodes_do_not_leak_across_sides(spark):
    # ID 5 is a supplier on side 1 and an (unrelated) nation on side 2 of a dropped edge
    df = spark.createDataFrame([(5, "S5", "Supplier", 1, "N1", "Nation", "e1"),
                                (5, "S5", "Supplier", 1, "N1", "Nation", "e2"),
                                (7, "S7", "Supplier", 5, "N5", "Nation", "e3")],
                               "NodeID1 int, NodeName1 string, Label1 string, NodeID2 int, NodeName2 string, "
                               "Label2 string, e string")
    g = G.edges_agg(df, weight_col="e", min_edges=2, node_att=["NodeName", "Label"])
    assert rows(g.nodes) == [(1, "N1", "Nation"), (5, "S5", "Supplier")]


def test_node_tables(spark):
    a = spark.createDataFrame([(1, "Team", "T1"), (2, "Team", "T2")], "NodeID int, Label string, NodeName string")
    b = spark.createDataFrame([(1, "Player", "P1", "IT"), (1, "Player", "P1b", "FR")],
                              "NodeID int, Label string, NodeName string, country string")
    merged = G.merge_nodes([a, b])
    assert merged.columns == ["Label", "NodeID", "NodeName", "country"]
    team = G.nodes_for_label(merged, "Team")
    assert team.columns == [":LABEL", "TEAM:ID", "NodeName"]
    assert rows(team) == [("Team", 1, "T1"), ("Team", 2, "T2")]
    assert rows(G.unique_nodes(merged)) == [("Player", 1, "P1", "IT"), ("Team", 1, "T1", None), ("Team", 2, "T2", None)]
    prof = G.label_profile(merged)
    assert prof == {"Team": ["NodeID", "NodeName"], "Player": ["NodeID", "NodeName", "country"]}


def test_endpoint_nodes_and_header_names(spark):
    df = spark.createDataFrame([(1, "a", 2, "b"), (2, "b", 1, "a")], "NodeID1 int, N1 string, NodeID2 int, N2 string")
    assert rows(G.endpoint_nodes(df, {"NodeID1": "N1", "NodeID2": ["N2"]})) == [(1, "a"), (2, "b")]
    assert G.edge_header_names(df).columns[:1] == ["NodeID1:START_ID"]


def test_endpoint_checks(spark):
    edges = spark.createDataFrame([(1, 10, 1), (2, 10, 1), (1, 11, 1)], "NodeID1 int, NodeID2 int, edge_weight int")
    nodes = spark.createDataFrame([(1, "S"), (10, "C"), (11, "S")], "NodeID int, Label string")
    assert rows(G.edges_with_endpoints(edges, nodes, "S", "C")) == [(1, 10, 1)]
    assert rows(G.dangling_edges(edges, nodes, "S", "C")) == [(1, 11, 1, False, True), (2, 10, 1, True, False)]


def test_node_lookup_gives_the_same_nodes(spark):
    ev = spark.createDataFrame([(1, 10, "e1"), (1, 10, "e2"), (2, 10, "e3"), (3, 11, "e4"), (3, 11, "e5"), (9, 12, "e6")],
                               "NodeID1 int, NodeID2 int, e string")
    sup = spark.createDataFrame([(1, "S1"), (2, "S2"), (3, "S3"), (3, "S3b")], "NodeID int, NodeName string")
    cus = spark.createDataFrame([(10, "C10"), (11, "C11")], "NodeID int, NodeName string")
    sup_l = sup.withColumn("Label", F.lit("S"))
    cus_l = cus.withColumn("Label", F.lit("C"))
    detail = (ev.join(sup.withColumnsRenamed({"NodeID": "NodeID1", "NodeName": "NodeName1"}), "NodeID1", "left")
                .join(cus.withColumnsRenamed({"NodeID": "NodeID2", "NodeName": "NodeName2"}), "NodeID2", "left")
                .withColumns({"Label1": F.lit("S"), "Label2": F.lit("C")}))
    plain = G.edges_agg(detail, weight_col="e", min_edges=2, node_att=["NodeName", "Label"], att_cols=[])
    looked = G.edges_agg(ev, weight_col="e", min_edges=2, node_att=["NodeName", "Label"], att_cols=[],
                         node_lookup={"NodeID1": sup_l, "NodeID2": cus_l})
    assert rows(looked.nodes) == rows(plain.nodes) == [(1, "S1", "S"), (10, "C10", "C"), (11, "C11", "C"),
                                                      (3, "S3", "S"), (3, "S3b", "S")]
    assert rows(looked.edges) == rows(plain.edges)
