"""Edge jobs (G10-G13), each a composition of operators via ``df.transform``.

The driver tables stand in for the reference's inputs:

* directed explicit edges (passes from player to player)  -> supplier sells to
  customer, from ``lineitem`` joined to ``orders``;
* undirected shared-key edges (played in the same team and match) -> parts
  bought in the same order with the same return flag, from ``lineitem``;
* bipartite membership edges (player plays for team) -> supplier based in nation.

Jobs only build plans; writing is a separate step (``export_graph``).
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkgraph.functions.expressions import day_text
from linkgraph.operators import columns as C
from linkgraph.operators import filters as Fl
from linkgraph.operators import graph as G
from linkgraph.operators.relational import dealt_alike, row_count
from linkgraph.session import cut_lineage, scratch_scope
from linkgraph.sources import sinks

# --- fixed values: job configuration ---------------------------------------
LABEL_PART = "Part"
LABEL_SUPPLIER = "Supplier"
LABEL_CUSTOMER = "Customer"
LABEL_NATION = "Nation"
NODE_ATT = ("NodeName", "Label")
# ---------------------------------------------------------------------------


def order_events(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per order line with its customer: the directed "event" table.

    Distinct counts of orders behind the join run in its tasks (they group by the order
    key too), so large tables are dealt by rows, which bounds what such a task holds.
    """
    o = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus", "o_orderdate")
    lines, o = dealt_alike([lineitem.select("l_orderkey", "l_suppkey", "l_linenumber"), o], "l_orderkey")
    return lines.join(o, on="l_orderkey", how="inner")


def _maybe_cut(df: DataFrame, checkpoint: bool) -> DataFrame:
    """Jobs that write both edges and nodes read the detail table several times:
    a reliable checkpoint (shared storage) computes it once and cuts the lineage,
    so a lost executor never re-runs the upstream joins."""
    return cut_lineage(df) if checkpoint else df


def directed_edges(lineitem: DataFrame, orders: DataFrame, supplier: DataFrame, customer: DataFrame,
                   min_edges: int = 2, checkpoint: bool = False) -> G.Graph:
    """Supplier -> customer edges, weight = distinct orders.

    read -> dropna -> drop_cols -> rename -> astype -> labels -> edges_agg.
    Node names come from the supplier and customer tables keyed by the node ID,
    so the node table joins the kept endpoint IDs to those tables instead of
    carrying names through the (large) order-line table.  Where ``min_edges`` drops
    pairs, sets are built for the others only.
    """
    detail = (order_events(lineitem, orders)
              .transform(Fl.dropna, subset=["o_custkey", "l_suppkey"])
              .transform(C.drop_cols, ["l_linenumber"])
              .transform(C.rename_cols, {"l_suppkey": "NodeID1", "o_custkey": "NodeID2"})
              .transform(C.astype, "bigint", ["NodeID1", "NodeID2"])
              .withColumn("order_date", day_text("o_orderdate"))
              .drop("o_orderdate"))
    detail = _maybe_cut(detail, checkpoint)
    lookups = {
        "NodeID1": supplier.select(F.col("s_suppkey").cast("bigint").alias("NodeID"),
                                   F.col("s_name").alias("NodeName"), F.lit(LABEL_SUPPLIER).alias("Label")),
        "NodeID2": customer.select(F.col("c_custkey").cast("bigint").alias("NodeID"),
                                   F.col("c_name").alias("NodeName"), F.lit(LABEL_CUSTOMER).alias("Label")),
    }
    return G.edges_agg(detail, weight_col="l_orderkey", col_date="order_date", min_edges=min_edges,
                       node_att=list(NODE_ATT), node_lookup=lookups, cut=checkpoint,
                       late_sets=min_edges > 1, large_sets=checkpoint, null_ids=False)


def shared_key_detail(lineitem: DataFrame) -> DataFrame:
    """Flagship input: one row per (order/return-flag key, part) with line status and ship day."""
    return (lineitem
            .transform(C.use_cols, ["l_orderkey", "l_partkey", "l_returnflag", "l_linestatus", "l_shipdate"])
            .transform(Fl.dropna, subset=["l_orderkey", "l_partkey", "l_returnflag"])
            .transform(C.add_literal, "Label", LABEL_PART)
            .transform(C.rename_cols, {"l_partkey": "NodeID"})
            .transform(C.concat_cols, "EdgeID", ["l_orderkey", "l_returnflag"], "_")
            .select("EdgeID", "NodeID", "Label", "l_linestatus",
                    day_text("l_shipdate").alias("ship")))


def shared_key_edges(lineitem: DataFrame, min_edges: int = 1, checkpoint: bool = False) -> G.Graph:
    """G11 (flagship): parts bought together.  Self-join on ``EdgeID`` -> pairs ->
    weighted edges with sets of keys and line statuses and the ship-date range."""
    detail = _maybe_cut(shared_key_detail(lineitem), checkpoint)
    # the aggregate below ignores duplicates, so the left side skips its distinct
    pairs = G.edges_from_shared_key(detail, "EdgeID", "NodeID", node_att=["Label"], distinct=False)
    # every part carries the same literal label, so a node's attributes do not depend on
    # the row it came from: look them up by ID instead of re-reading the pair table
    parts = detail.select("NodeID", "Label").dropDuplicates()
    return G.edges_agg(pairs, weight_col="EdgeID", col_date="ship", min_edges=min_edges,
                       node_att=["Label"], att_cols=["EdgeID", "l_linestatus"],
                       node_lookup={"NodeID1": parts, "NodeID2": parts}, cut=checkpoint)


def bipartite_edges(supplier: DataFrame, nation: DataFrame, checkpoint: bool = False) -> G.Graph:
    """Supplier -- nation membership edges, weight = distinct membership keys (1)."""
    detail = (supplier.join(nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name"),
                            on="s_nationkey", how="left")
              .transform(C.use_cols, ["s_suppkey", "s_name", "s_nationkey", "n_name"])
              .transform(C.rename_cols, {"s_suppkey": "NodeID1", "s_name": "NodeName1"})
              .transform(Fl.dropna, subset=["NodeID1", "s_nationkey"])
              .transform(C.add_literal, "Label1", LABEL_SUPPLIER)
              .transform(C.concat_cols, "EdgeID", ["NodeID1", "s_nationkey"], "_")
              .dropDuplicates()
              .transform(C.rename_cols, {"s_nationkey": "NodeID2", "n_name": "NodeName2"})
              .transform(C.add_literal, "Label2", LABEL_NATION))
    detail = _maybe_cut(detail, checkpoint)
    return G.edges_agg(detail, weight_col="EdgeID", node_att=list(NODE_ATT), cut=checkpoint)


class GraphJob(NamedTuple):
    relationships: dict[str, G.Graph]
    nodes: DataFrame


def whole_graph(tables: Mapping[str, DataFrame], min_directed: int = 2, checkpoint: bool = True) -> GraphJob:
    """The three edge jobs and one merged node table.  Nodes and edges both derive
    from the pair tables, so by default each detail and edge table is computed once and
    stored, lineage cut; ``checkpoint=False`` gives plans only."""
    rels = {
        "supplies": directed_edges(tables["lineitem"], tables["orders"], tables["supplier"],
                                   tables["customer"], min_edges=min_directed, checkpoint=checkpoint),
        "bought_with": shared_key_edges(tables["lineitem"], checkpoint=checkpoint),
        "based_in": bipartite_edges(tables["supplier"], tables["nation"], checkpoint=checkpoint),
    }
    nodes = G.merge_nodes([g.nodes for g in rels.values()])
    return GraphJob(rels, nodes)


def graph_summary(job: GraphJob) -> DataFrame:
    """Counts per relationship and per node label (lazy; one job when collected)."""
    parts = [row_count(g.edges).select(F.lit("relationship").alias("kind"), F.lit(name).alias("name"),
                                       F.col("n_rows"))
             for name, g in job.relationships.items()]
    parts.append(job.nodes.groupBy("Label").agg(F.count(F.lit(1)).alias("n_rows"))
                 .select(F.lit("node").alias("kind"), F.col("Label").alias("name"), "n_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def export_graph(job: GraphJob, base_dir: str) -> list[dict[str, str]]:
    """Write every relationship and every node label, and the manifest last.

    ``write_nodes`` stores the merged node table once, so that the per-label profile
    and writes scan it (label filter pushed to the scan).  All files are staged and
    moved when the last write has succeeded: whatever fails, ``base_dir`` holds a
    whole export with its manifest, or none with a manifest.
    """
    spark = job.nodes.sparkSession
    base = base_dir.rstrip("/")
    with sinks.staged_export(spark, base) as stage:
        written = [sinks.write_edges(g.edges, stage, name) for name, g in job.relationships.items()]
        written += sinks.write_nodes(job.nodes, stage)
    written = [{**e, "data": e["data"].replace(stage, base, 1), "header": e["header"].replace(stage, base, 1)} for e in written]
    sinks.write_manifest(spark, written, base)
    return written


def export_whole_graph(tables: Mapping[str, DataFrame], base_dir: str, min_directed: int = 2) -> list[dict[str, str]]:
    """G13 to its end: build the whole graph, export it, and give back all intermediate tables.

    The detail and edge tables are stored once each inside a scope, which deletes
    them when the export is in place or has failed.
    """
    spark = next(iter(tables.values())).sparkSession
    with scratch_scope(spark):
        return export_graph(whole_graph(tables, min_directed, checkpoint=True), base_dir)


def export_flat_inputs(lineups: DataFrame, passes: DataFrame, base_dir: str) -> dict[str, str]:
    """Write the flattened nested inputs for the edge jobs: the enriched lineup
    table as pipe-separated CSV with header (read back with ``EXPORT_CSV_OPTIONS``, values
    come out as they were), the pass events as Parquet."""
    return {
        "lineups": sinks.save_file(lineups, base_dir, "lineups", fmt="csv",
                                   options={"sep": sinks.EXPORT_SEP, "header": "true"}),
        "passes": sinks.save_file(passes, base_dir, "passes", fmt="parquet"),
    }
