"""What one task holds does not grow with the input: large tables are dealt by rows."""

import os
import re

import pytest
from pyspark.sql import functions as F

from linkgraph.operators import graph as G
from linkgraph.operators import relational as R
from linkgraph.plans import jobs as J
from linkgraph.plans import workload as W
from tests.conftest import SF_SMALL, rows
from tools.plan_audit import plan_text


@pytest.fixture
def trade(spark):
    lines = spark.range(400).select((F.col("id") % 50).alias("l_orderkey"), (F.col("id") % 7).alias("l_suppkey"), F.lit(1).alias("l_linenumber"))
    orders = spark.range(50).selectExpr("id AS o_orderkey", "id % 5 AS o_custkey", "'O' AS o_orderstatus", "TIMESTAMP_NTZ'1997-01-01' AS o_orderdate")
    supplier = spark.range(7).selectExpr("id AS s_suppkey", "concat('S', id) AS s_name")
    customer = spark.range(5).selectExpr("id AS c_custkey", "concat('C', id) AS c_name")
    return lines, orders, supplier, customer


def test_order_lines_are_dealt_by_rows(spark, trade, monkeypatch):
    small = J.directed_edges(*trade)
    want = rows(small.edges), rows(small.nodes)
    assert "REPARTITION_BY_NUM" not in plan_text(J.order_events(*trade[:2]))
    monkeypatch.setattr(R, "TASK_ROWS", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        events = J.order_events(*trade[:2])
        assert re.findall(r"Exchange hashpartitioning\(l_orderkey#\d+L, (\d+)\), REPARTITION_BY_NUM", plan_text(events)) == ["40", "40"]
        large = J.directed_edges(*trade)
        assert (rows(large.edges), rows(large.nodes)) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_nested_lineups_shuffle_plain_rows_once_and_are_packed(spark):
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan_text(W._nested_lineups(spark, SF_SMALL)))
    assert [re.sub(r"#\d+L?", "", x) for x in exchanges] == ["l_orderkey, 8"]
    path = W._lineup_json(spark, SF_SMALL)
    parts = [f for f in os.listdir(path.removeprefix("file:")) if f.startswith("part-")]
    assert parts and all(f.endswith(".json.gz") for f in parts)


@pytest.fixture
def baskets(spark):
    return spark.range(3000).select((F.col("id") % 1000).alias("EdgeID"), (F.col("id") * 7 % 131).alias("NodeID"), F.lit("x").alias("a"))


def test_shared_keys_are_dealt_by_rows(spark, baskets, monkeypatch):
    want = rows(G.edges_from_shared_key(baskets))
    monkeypatch.setattr(R, "TASK_ROWS", 100)
    pairs = G.edges_from_shared_key(baskets)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert re.findall(r"Exchange hashpartitioning\(EdgeID#\d+L, (\d+)\), REPARTITION_BY_NUM", plan_text(pairs)) == ["30", "30"]
        assert rows(pairs) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("hot", [0, 400])
def test_finer_histogram_finds_hot_keys_or_ends(baskets, hot):
    """Most buckets could hold a hot key: the finer histogram decides, and without a candidate nothing more is read."""
    df = baskets.select("EdgeID").unionAll(baskets.select(F.lit(5).cast("bigint").alias("EdgeID")).limit(hot))
    found, n = G._hot_keys(df, "EdgeID", target_parts=8, buckets=64)
    assert n == 3000 + hot and {r.EdgeID for r in found.collect()} == ({5} if hot else set())
    assert hot or plan_text(found).startswith("LocalTableScan <empty>")


@pytest.fixture
def dated(spark):
    found = [(i % 3 if i % 3 else None, i % 2, i % 11, None if i % 2 else f"1997-01-{i % 28 + 1:02d}") for i in range(60)] + [(7, 8, 1, "1997-02-01"), (7, 8, 2, None)]
    return spark.createDataFrame(found, "NodeID1 BIGINT, NodeID2 BIGINT, e BIGINT, day STRING")


def test_weights_of_late_sets_are_a_hash_aggregate(dated, monkeypatch):
    plans = {}
    monkeypatch.setattr(G, "cut_lineage", lambda df, name="lineage": plans.setdefault(name, plan_text(df)) and df)
    G.edges_agg(dated, "e", col_date="day", min_edges=2, large_sets=True)
    assert "HashAggregate" in plans["weights"] and "SortAggregate" not in plans["weights"]


def test_date_range_of_wide_edges(dated, monkeypatch):
    want = rows(G.edges_agg(dated, "e", col_date="day", min_edges=2).edges)
    monkeypatch.setattr(G, "SET_ROWS", 5)  # all but one edge are wide, some with a NULL endpoint or no day
    assert rows(G.edges_agg(dated, "e", col_date="day", min_edges=2, large_sets=True).edges) == want
    assert len(want) > 3
