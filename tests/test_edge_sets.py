"""Sets of weighted edges: built late, and in chunks, they equal those of the one-pass aggregate."""

import random
import re

import pytest

from linkgraph.operators import graph as G
from linkgraph.plans import jobs as J
from tests.conftest import SF_SMALL, rows
from tools.plan_audit import plan_text

SCHEMA = "NodeID1 int, NodeID2 int, event long, kind string, day date, n double"


def events(spark, n=600, seed=4):
    import datetime as dt
    rnd = random.Random(seed)
    kinds = ["b", "a", "", "é", "a, b", None, None]
    data = [(rnd.choice([1, 2, 3, None]), rnd.choice([1, 2, None]), rnd.choice([None, *range(40)]), rnd.choice(kinds),
             dt.date(2020, 1, rnd.randrange(1, 29)), rnd.choice([None, 1.5, 2.0, -0.0])) for _ in range(n)]
    data += [(9, 9, 1, None, None, None), (9, 9, 2, None, None, None), (8, 8, None, None, None, None)]
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("min_edges", [0, 1, 2, 30])
@pytest.mark.parametrize("date", [None, "day"])
def test_late_and_chunked_sets_equal_the_plain_ones(spark, monkeypatch, min_edges, date):
    df = events(spark)
    plain = G.edges_agg(df, "event", min_edges=min_edges, col_date=date)
    late = G.edges_agg(df, "event", min_edges=min_edges, col_date=date, late_sets=True)
    monkeypatch.setattr(G, "SET_ROWS", 40)  # some pairs have fewer rows, some more
    large = G.edges_agg(df, "event", min_edges=min_edges, col_date=date, large_sets=True)
    assert late.edges.columns == large.edges.columns == plain.edges.columns
    assert late.edges.dtypes == large.edges.dtypes == plain.edges.dtypes
    assert rows(late.edges) == rows(large.edges) == rows(plain.edges)
    assert rows(late.nodes) == rows(large.nodes) == rows(plain.nodes)


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_chunks_are_put_together_in_order(spark, chunk):
    rnd = random.Random(chunk)
    data = [(k, str(rnd.randrange(60)), rnd.choice(["x", "y", None])) for k in ("p", "q", None) for _ in range(200)]
    df = spark.createDataFrame(data, "k string, v string, w string").repartition(4)
    got = G.chunked_sets(df, ["k"], ["v", "w"], len(data), chunk)
    want = [(k, *["[" + ", ".join(sorted({r[i] for r in data if r[0] == k and r[i] is not None})) + "]" for i in (1, 2)])
            for k in ("p", "q", None)]
    assert rows(got.select("k", "v_att", "w_att")) == sorted(want, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_a_wide_edge_is_cut_into_slices(spark):
    """No task of the rendering holds more than a few chunks of the set."""
    n = 60_000
    df = spark.range(n).selectExpr("1 AS NodeID1", "2 AS NodeID2", "id AS event")
    values = df.select("NodeID1", "NodeID2", "event").distinct().repartitionByRange(30, "NodeID1", "NodeID2", "event")
    sizes = [r["count"] for r in values.groupBy(G.F.spark_partition_id()).count().collect()]
    assert max(sizes) < 3 * n / 30  # one edge, thirty slices
    text = G.chunked_sets(df, ["NodeID1", "NodeID2"], ["event"], n, 2000).first()["event_att"]
    assert text[1:-1].split(", ") == sorted(map(str, range(n)))


def test_directed_job_builds_sets_of_kept_pairs_only(spark):
    t = {n: spark.read.parquet(f"{SF_SMALL}/{n}.parquet") for n in ("lineitem", "orders", "supplier", "customer")}
    plan = plan_text(J.directed_edges(t["lineitem"], t["orders"], t["supplier"], t["customer"], min_edges=2).edges)
    sets = plan.index("collect_set")  # plans read from the result downwards: the semi-join feeds the sets
    assert sets < plan.index("LeftSemi") and len(re.findall(r"LeftSemi", plan)) >= 1
    stored = J.directed_edges(t["lineitem"], t["orders"], t["supplier"], t["customer"], min_edges=2, checkpoint=True)
    lazy = J.directed_edges(t["lineitem"], t["orders"], t["supplier"], t["customer"], min_edges=2)
    assert rows(stored.edges) == rows(lazy.edges) and rows(stored.nodes) == rows(lazy.nodes)
