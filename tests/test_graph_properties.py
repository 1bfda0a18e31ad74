"""Property tests: graph operators against brute-force answers on random small tables."""

import itertools
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from linkgraph.operators import graph as G

ROW = st.tuples(st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), st.integers(0, 6)),
                st.sampled_from(["x", "y"]))
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(ROW, min_size=0, max_size=25), st.booleans())
def test_shared_key_pairs_property(spark, data, split):
    df = spark.createDataFrame(data, "EdgeID string, NodeID int, t string")
    got = [tuple(r) for r in G.edges_from_shared_key(df, split_hot_keys=split, target_parts=4).collect()]
    expect = {(k1, n1, t1, n2) for (k1, n1, t1), (k2, n2, _) in itertools.product(data, data)
              if k1 is not None and k1 == k2 and n1 is not None and n2 is not None and n1 > n2}
    assert len(got) == len(set(got))
    assert set(got) == expect


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.one_of(st.none(), st.sampled_from(["m1", "m2", "m3"])),
                          st.sampled_from(["2020-01-01", "2020-02-01"])), min_size=1, max_size=20),
       st.integers(0, 3))
def test_edges_agg_property(spark, data, min_edges):
    df = spark.createDataFrame(data, "NodeID1 int, NodeID2 int, m string, d string")
    edges = G.edges_agg(df, weight_col="m", col_date="d", min_edges=min_edges).edges
    got = {(r.NodeID1, r.NodeID2): (r.edge_weight, r.m_att, r.d_att, r.d_min, r.d_max) for r in edges.collect()}
    expect = {}
    for a, b in {(r[0], r[1]) for r in data}:
        grp = [r for r in data if (r[0], r[1]) == (a, b)]
        ms = sorted({r[2] for r in grp if r[2] is not None})
        ds = sorted({r[3] for r in grp})
        if len(ms) >= min_edges:
            expect[(a, b)] = (len(ms), "[" + ", ".join(ms) + "]", "[" + ", ".join(ds) + "]", ds[0], ds[-1])
    assert got == expect


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 400)), min_size=1, max_size=12), st.integers(1, 6))
def test_hot_key_list_is_bounded(spark, groups, parts):
    """Whatever the key sizes, fewer than `parts` + 1 keys come back, each with 2..parts splits, and exactly
    those with more than a partition's share of the pair work."""
    data = [(f"k{key}", node) for key, size in groups for node in range(size)]
    df = spark.createDataFrame(data, "EdgeID string, NodeID int")
    hot = {r["EdgeID"]: r["__splits__"] for r in G.hot_key_splits(df, "EdgeID", target_parts=parts).collect()}
    sizes = {}
    for key, size in groups:
        sizes[f"k{key}"] = sizes.get(f"k{key}", 0) + size
    work = sum(k * k for k in sizes.values())
    assert hot == {key: math.ceil(k * k * parts / work) for key, k in sizes.items() if math.ceil(k * k * parts / work) >= 2}
    assert len(hot) <= parts and all(2 <= n <= parts for n in hot.values())
