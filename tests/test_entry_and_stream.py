import pytest

import __spark_entry__ as E
from linkgraph.operators import columns as C
from linkgraph.operators import filters as Fl
from linkgraph.plans import workload as W
from linkgraph.session import scratch_path
from linkgraph.streaming import apply_steps, clean_stream
from tests.conftest import SF_SMALL


def test_entry_runs_with_stable_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["NodeID1", "NodeID2", "edge_weight", "EdgeID_att", "l_linestatus_att", "ship_min", "ship_max"]
    r = df.collect()
    assert len(r) > 0
    assert all(x.NodeID1 > x.NodeID2 for x in r)
    assert all(x.edge_weight == len(x.EdgeID_att.strip("[]").split(", ")) for x in r)


def test_every_query_has_an_oracle():
    assert set(W.QUERIES) == set(W.ORACLE)
    assert set(W.QUERIES) <= set(E.queries())
    assert len(W.QUERIES) >= 60


@pytest.mark.parametrize("name", ["job_bipartite_edges", "graph_nodes", "metric_pct_change", "flatten_lineup",
                                  "import_manifest", "read_csv_schema", "parse_with_rejects"])
def test_queries_run_on_smoke_data(spark, name):
    assert E.queries()[name](spark, SF_SMALL).count() >= 0


def test_stateless_steps_on_a_stream(spark):
    src = scratch_path(spark, "t-stream-src")
    spark.read.parquet(f"{SF_SMALL}/customer.parquet").write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    steps = [(C.use_cols, {"keep_cols": ["c_custkey", "c_name"]}),
             (C.rename_cols, {"renamed_cols": {"c_custkey": "NodeID", "c_name": "NodeName"}}),
             (C.add_literal, {"col_new": "Label", "value": "Customer"}),
             (Fl.filter_has_digits, {"col": "NodeName"})]
    sink, ck = scratch_path(spark, "t-stream-out"), scratch_path(spark, "t-stream-ck")
    q = clean_stream(stream, steps, sink, ck)
    q.awaitTermination(120)
    out = spark.read.parquet(sink)
    assert out.columns == ["NodeID", "NodeName", "Label"]
    assert out.count() == spark.read.parquet(src).count()
    with pytest.raises(ValueError):
        apply_steps(stream, [(Fl.drop_duplicates, {})])
