"""The salted shared-key join on real rows: a key holding ~1.7 % of the order lines
(about half of all pair work) is detected, split, and gives exactly the unsplit result."""

import random

import pytest
from pyspark.sql import functions as F

from linkgraph.operators import graph as G

SF = "/root/testdata/sf0.01"


def test_hot_key_split_equals_unsplit(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    hot = F.col("l_orderkey") % 60 == 0  # moves ~1000 order lines onto one key
    key = F.when(hot, F.lit("HOT")).otherwise(F.concat_ws("_", "l_orderkey", "l_returnflag"))
    d = li.select(key.alias("EdgeID"), F.col("l_partkey").alias("NodeID"), "l_linestatus")
    found = G.hot_key_splits(d, "EdgeID").collect()
    assert [r.EdgeID for r in found] == ["HOT"] and found[0]["__splits__"] >= 2

    def edges(split):
        pairs = G.edges_from_shared_key(d, split_hot_keys=split, distinct=False)
        return G.edges_agg(pairs, weight_col="EdgeID", att_cols=["EdgeID", "l_linestatus"]).edges

    def fingerprint(e):
        return tuple(e.agg(F.count(F.lit(1)), F.sum("edge_weight"),
                           F.bit_xor(F.xxhash64("NodeID1", "NodeID2", "EdgeID_att", "l_linestatus_att"))).first())

    a, b = fingerprint(edges(True)), fingerprint(edges(False))
    assert a == b and a[0] > 300_000


def _shares(df):
    """Rows of each task, as shares of all rows."""
    n = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    return [x / sum(n) for x in n]


@pytest.mark.parametrize("hot", ["key", "key and node"])
def test_no_task_has_a_tenth_of_the_pairs(spark, hot):
    """One hot key, and one key with a node on most of its rows; adaptive execution as it is by default."""
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    n = 2000
    node = F.col("id") if hot == "key" else F.when(F.col("id") < n * 5 // 6, 10**6).otherwise(F.col("id"))
    rows = (spark.range(n).select(F.lit("hot").alias("EdgeID"), node.alias("NodeID"), F.col("id").alias("day"))
            .union(spark.range(4000).select(F.concat(F.lit("k"), F.col("id") % 1000), "id", "id")))
    pairs = G.edges_from_shared_key(rows, distinct=False, target_parts=64)
    assert max(_shares(pairs)) <= 0.1
    small = G.edges_from_shared_key(rows.where("day % 7 = 0"), distinct=False, target_parts=64)
    plain = G.edges_from_shared_key(rows.where("day % 7 = 0"), split_hot_keys=False)
    assert small.exceptAll(plain).count() == plain.exceptAll(small).count() == 0


def test_threshold_filter_joins_last(spark):
    """The detail is made distinct on all columns (a hot group is spread there); the join that follows can be split."""
    rows = spark.range(4000).select(F.when(F.col("id") < 2000, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 500)).alias("g"),
                                    (F.col("id") % 1000).alias("n"))
    out = G.filter_edges_by_threshold(rows, "n", ["g"], 3, 10**6)
    assert [tuple(r) for r in out.groupBy("g").count().collect()] == [("hot", 1000)]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = G.filter_edges_by_threshold(rows, "n", ["g"], 3, 10**6)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.index("LeftSemi") < plan.index("Aggregate")


def _exact_hot(pairs, parts):
    """Hot keys by an exact count of every key."""
    n = {}
    for k in pairs:
        if k is not None:
            n[k] = n.get(k, 0) + 1
    total = sum(c * c for c in n.values())
    return {k: c * c * parts / total for k, c in n.items()}


@pytest.mark.parametrize("buckets", [64, 1024, 8192])
def test_bucket_detection_against_exact_counts(spark, buckets):
    """Keys with clearly more than a share are found whatever the buckets, keys with clearly less never."""
    rnd = random.Random(buckets)
    keys = [f"k{i}" for i in range(3000) for _ in range(rnd.randrange(1, 6))] + [None] * 500
    for k, n in (("a", 900), ("b", 450), ("c", 300), ("d", 40)):
        keys += [k] * n
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "EdgeID string, NodeID long").repartition(5)
    share = _exact_hot(keys, 32)
    error = 4 * (2 / buckets) ** 0.5
    got = {r.EdgeID: r["__splits__"] for r in G.hot_key_splits(df, "EdgeID", 32, buckets=buckets).collect()}
    assert {k for k, x in share.items() if x > 1 + error} <= set(got) <= {k for k, x in share.items() if x > 1 - error}
    assert all(abs(got[k] - share[k]) <= 1 + error * share[k] for k in got)


def test_detection_of_nothing(spark):
    even = spark.range(20_000).select((F.col("id") % 5000).cast("string").alias("EdgeID"))
    assert G.hot_key_splits(even, "EdgeID", 16).collect() == []
    assert G.hot_key_splits(even.where("false"), "EdgeID", 16).collect() == []
    assert G.hot_key_splits(even.select(F.lit(None).cast("string").alias("EdgeID")), "EdgeID", 16).collect() == []
    # every bucket is full: the finer histogram decides, and the single hot key is found
    crowded = even.union(spark.range(400).select(F.lit("hot")))
    assert [r.EdgeID for r in G.hot_key_splits(crowded, "EdgeID", 16, buckets=8).collect()] == ["hot"]


def test_detection_of_even_keys_is_one_job_over_the_key(spark):
    sc = spark.sparkContext
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    sc.setJobGroup("detect", "detect")
    try:
        G.hot_key_splits(li, "l_orderkey").collect()
        jobs = sc.statusTracker().getJobIdsForGroup("detect")
    finally:
        sc._jsc.clearJobGroup()
    assert len(jobs) <= 2  # adaptive execution submits the shuffle and the result apart
