import os

import pytest

from linkgraph.operators import graph as G
from linkgraph.session import scratch_path
from linkgraph.sources import readers as S
from linkgraph.sources import sinks as K
from tests.conftest import SF_SMALL, rows


def test_csv_round_trip_with_schema_and_awkward_values(spark):
    df = spark.createDataFrame([(1, 'a|b', 'say "hi"'), (2, "", None)], "id int, s string, t string")
    base = scratch_path(spark, "t-roundtrip")
    K.save_file(df, base, "x", fmt="csv", single_file=True, save_header_file=True,
                options={"sep": "|", "header": "true", "escape": '"', "nullValue": "\\N"})
    back = S.read_file(spark, f"{base}/x", dtype=[["id", "int"], ["s", "string"], ["t", "string"]],
                       options={"sep": "|", "header": "true", "escape": '"', "nullValue": "\\N"})
    assert rows(back) == [(1, "a|b", 'say "hi"'), (2, "", None)]
    assert spark.read.text(f"{base}/x_header").first().value == "id|s|t"
    assert len([f for f in os.listdir(f"{base}/x".replace("file:", "")) if f.startswith("part-")]) == 1


def test_edge_and_node_export_with_manifest(spark):
    edges = spark.createDataFrame([(2, 1, 1, ["b", "a"])], "NodeID1 int, NodeID2 int, edge_weight int, m_att array<string>")
    nodes = spark.createDataFrame([(1, "Team", "T|1", None), (2, "Team", "T2", None), (3, "Player", "P", "IT")],
                                  "NodeID int, Label string, NodeName string, country string")
    base = scratch_path(spark, "t-export")
    written = [K.write_edges(edges, base, "rel")] + K.write_nodes(nodes, base)
    back = K.read_export(spark, written[0])
    assert back.columns == ["NodeID1:START_ID", "NodeID2:END_ID", "edge_weight", "m_att"]
    assert rows(back) == [("2", "1", "1", "[b,a]")]
    team = next(w for w in written if w["name"] == "Team")
    assert rows(K.read_export(spark, team)) == [("1", "Team", "T|1"), ("2", "Team", "T2")]
    man = K.import_manifest(spark, written, base)
    assert rows(man) == [("node", "Player", "nodes/Player_header", "nodes/Player/part-*", 1),
                         ("node", "Team", "nodes/Team_header", "nodes/Team/part-*", 2),
                         ("relationship", "rel", "rel_header", "rel_edges/part-*", 1)]


def test_read_by_prefix(spark):
    base = scratch_path(spark, "t-prefix")
    spark.read.parquet(f"{SF_SMALL}/nation.parquet").write.parquet(f"{base}/NationDoc_a")
    spark.read.parquet(f"{SF_SMALL}/region.parquet").write.parquet(f"{base}/RegionDoc_b")
    spark.read.parquet(f"{SF_SMALL}/region.parquet").write.parquet(f"{base}/OtherStuff")
    got = S.read_by_prefix(spark, base, ["Nation", "Region"]).groupBy("kind").count()
    assert rows(got) == [("Nation", 25), ("Region", 5)]


def test_schema_pairs_to_ddl():
    assert S.to_ddl([["a", "int"], ["b", "decimal(10,2)"]]) == "`a` int, `b` decimal(10,2)"
    assert S.to_ddl("a INT") == "a INT"
    assert G.LABEL_HEADER == ":LABEL"


def test_create_schema_pairs(spark):
    st = S.create_schema([["id", "int"], ["name", "string"]])
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in st.fields] == [
        ("id", "int", False), ("name", "string", False)]


def test_export_flat_inputs_round_trip(spark):
    from linkgraph.plans import jobs as J
    lineups = spark.createDataFrame([(1, "T|1", "P")], "match_id int, team_name string, player_name string")
    passes = spark.createDataFrame([(1, 2, 3.5)], "match_id int, player int, length double")
    base = scratch_path(spark, "t-flat")
    out = J.export_flat_inputs(lineups, passes, base)
    back = spark.read.options(sep="|", header="true", escape='"').schema(lineups.schema).csv(out["lineups"])
    assert rows(back) == [(1, "T|1", "P")]
    assert rows(spark.read.parquet(out["passes"])) == [(1, 2, 3.5)]


def test_scratch_and_lineage_cut(spark):
    from linkgraph.session import checkpoint_root, cut_lineage
    root = checkpoint_root(spark)
    p = scratch_path(spark, "x")
    assert p.startswith(root + "/linkgraph/x-")
    df = spark.range(10).withColumnRenamed("id", "v")
    cut = cut_lineage(df.where("v % 2 = 0"))
    assert "Scan parquet" in cut._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.v for r in cut.collect()) == [0, 2, 4, 6, 8]


AWKWARD = ["two\nlines", "cr\r\nlf", " lead", "trail ", "", None, "a|b", 'q"uo"te', "\\", "é", "plain", "\t"]


def test_export_keeps_awkward_values(spark):
    base = scratch_path(spark, "t-awkward")
    data = [(i, "Player", v) for i, v in enumerate(AWKWARD)] + [(99, None, "no label")]
    nodes = spark.createDataFrame(data, "NodeID int, Label string, NodeName string")
    written = K.write_nodes(nodes, base)
    assert [e["name"] for e in written] == ["Player"]  # a node without a label belongs to no file
    back = {int(r["PLAYER:ID"]): r["NodeName"] for r in K.read_export(spark, written[0]).collect()}
    assert back == dict(enumerate(AWKWARD))
    edges = spark.createDataFrame([(1, 2, 1, "[a\nb, c]"), (1, 3, 1, None)], "NodeID1 int, NodeID2 int, edge_weight int, k_att string")
    e = K.write_edges(edges, base, "rel")
    assert sorted((r["NodeID2:END_ID"], r["k_att"]) for r in K.read_export(spark, e).collect()) == [("2", "[a\nb, c]"), ("3", None)]
    counts = {r.name: r.row_count for r in K.import_manifest(spark, [*written, e], base).collect()}
    assert counts == {"Player": len(AWKWARD), "rel": 2}


def test_header_is_one_file_without_line_break(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "`NodeID:ID` int, `é` string")
    path = K.save_header(df, f"file://{tmp_path}/T_header")
    assert (tmp_path / "T_header").read_bytes() == "NodeID:ID|é".encode()
    assert path.endswith("T_header")


def test_kinds_with_other_types(spark):
    base = scratch_path(spark, "t-kinds")
    spark.createDataFrame([(1, "a")], "id int, v string").write.parquet(f"{base}/OneDoc_1")
    spark.createDataFrame([("x", 2.5)], "id string, v double").write.parquet(f"{base}/TwoDoc_1")
    spark.range(3).write.parquet(f"{base}/OtherDoc_1")
    kinds = S.read_kinds(spark, base, ["One", "Two"])
    assert {k: df.dtypes for k, df in kinds.items()} == {"One": [("id", "int"), ("v", "string")], "Two": [("id", "string"), ("v", "double")]}
    assert rows(S.read_by_prefix(spark, base, ["One", "Two"]).select("kind", "id", "v")) == [("One", "1", "a"), ("Two", "x", "2.5")]


def test_no_scratch_outside_shared_storage(monkeypatch):
    import linkgraph.session as session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="checkpoint"):
        session.checkpoint_root(Session())


def test_saved_csv_keeps_awkward_values(spark):
    base = scratch_path(spark, "t-save")
    df = spark.createDataFrame(list(enumerate(AWKWARD)), "id int, `na|me` string").repartition(4)
    schema = S.create_schema([["id", "int"], ["na|me", "string"]], nullable=True)
    for single in (False, True):
        path = K.save_file(df, base, f"x{single}", single_file=single, options={"sep": "|", "header": "true"})
        back = spark.read.options(**S.EXPORT_CSV_OPTIONS).schema(schema).csv(path)
        assert {r[0]: r[1] for r in back.collect()} == dict(enumerate(AWKWARD))
    named = spark.read.options(**S.EXPORT_CSV_OPTIONS).csv(f"{base}/xTrue")
    assert named.columns == ["id", "na|me"]


def _parts(path):
    return [f for f in os.listdir(path.replace("file:", "")) if f.startswith("part-")]


@pytest.mark.parametrize("fmt,options", [("csv", {"header": "true"}), ("csv", {}), ("csv", {"header": "true", "compression": "gzip"}),
                                         ("json", {}), ("text", {}), ("json", {"compression": "gzip"}), ("parquet", {})])
def test_single_file_is_joined_in_order(spark, fmt, options):
    """One file in part order, from seven partitions."""
    base = scratch_path(spark, "t-single")
    df = spark.range(1000).repartitionByRange(7, "id").sortWithinPartitions("id").selectExpr("CAST(id AS STRING) AS id")
    assert df.rdd.getNumPartitions() == 7
    path = K.save_file(df, base, "one", fmt=fmt, single_file=True, options=options)
    assert len(_parts(path)) == 1
    back = spark.read.options(**options).format(fmt).load(path).collect()
    assert [r[0] for r in back] == [str(i) for i in range(1000)] or fmt == "parquet"
    assert sorted(int(r[0]) for r in back) == list(range(1000))
    assert os.listdir(base.replace("file:", "")) == ["one"]  # no staging folder stays
    if fmt != "parquet":
        K.save_file(df.limit(3), base, "one", fmt=fmt, single_file=True, mode="append", options=options)
        assert len(_parts(path)) == 2 and spark.read.options(**options).format(fmt).load(path).count() == 1003
        with pytest.raises(FileExistsError):
            K.save_file(df, base, "one", fmt=fmt, single_file=True, mode="error", options=options)
        K.save_file(df.limit(0), base, "one", fmt=fmt, single_file=True, mode="ignore", options=options)
        K.save_file(df.limit(2), base, "one", fmt=fmt, single_file=True, options=options)
        assert spark.read.options(**options).format(fmt).load(path).count() == 2
        K.save_file(df.limit(0), base, "none", fmt=fmt, single_file=True, options=options)
        assert len(_parts(f"{base}/none")) == 1


def test_export_is_complete_or_has_no_manifest(spark, monkeypatch):
    from linkgraph.plans import jobs as J
    edges = spark.createDataFrame([(1, 2, 1)], "NodeID1 int, NodeID2 int, edge_weight int")
    nodes = spark.createDataFrame([(1, "A", "x"), (2, "B", "y")], "NodeID int, Label string, NodeName string")
    job = J.GraphJob({"r1": G.Graph(edges, nodes), "r2": G.Graph(edges, nodes)}, nodes)
    base = scratch_path(spark, "t-whole")
    place = base.replace("file:", "")
    whole = {"import_manifest", "nodes", "r1_edges", "r1_header", "r2_edges", "r2_header"}
    write, calls = K._write_counted, []

    def failing(df, path):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("the disk is full")
        return write(df, path)

    monkeypatch.setattr(K, "_write_counted", failing)
    with pytest.raises(RuntimeError):
        J.export_graph(job, base)
    assert not os.path.exists(f"{place}/import_manifest") and not any(f.startswith("_staging") for f in os.listdir(place))
    monkeypatch.setattr(K, "_write_counted", write)
    entries = J.export_graph(job, base)
    assert {f for f in os.listdir(place) if not f.startswith(".")} == whole
    written = spark.read.options(**S.EXPORT_CSV_OPTIONS).csv(f"{base}/import_manifest")
    assert rows(written.select("kind", "name")) == rows(K.import_manifest(spark, entries, base).select("kind", "name"))
    assert rows(K.read_export(spark, entries[0])) == [("1", "2", "1")]
    # a failing second export leaves the first one whole
    calls.clear()
    monkeypatch.setattr(K, "_write_counted", failing)
    with pytest.raises(RuntimeError):
        J.export_graph(job, base)
    assert {f for f in os.listdir(place) if not f.startswith(".")} == whole

    # a move that fails leaves no manifest behind
    monkeypatch.setattr(K, "_write_counted", write)
    move = K._move

    def stuck(spark, source, target):
        if target.endswith("r1_header"):
            raise OSError("no")
        move(spark, source, target)

    monkeypatch.setattr(K, "_move", stuck)
    with pytest.raises(OSError):
        J.export_graph(job, base)
    assert not os.path.exists(f"{place}/import_manifest")
