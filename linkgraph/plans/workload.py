"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator key,
each with the DuckDB SQL that must give the same rows (the correctness oracle).

Every query reads the driver tables under ``sf_dir`` (whole tables, no key
subsets) or data Spark derives from them.  Queries that round-trip through
files write into a fresh folder under the session's checkpoint directory.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkgraph.operators import columns as C
from linkgraph.operators import filters as Fl
from linkgraph.operators import graph as G
from linkgraph.operators import metrics as M
from linkgraph.operators import nested as N
from linkgraph.operators import relational as R
from linkgraph.plans import jobs as J
from linkgraph.session import cache, scratch_path, scratch_scope
from linkgraph.sources import readers as S
from linkgraph.sources import sinks as K

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [table(spark, sf_dir, n) for n in names]


def _set_sql(expr: str) -> str:
    return f"'[' || array_to_string(list_sort(list_distinct(list(CAST({expr} AS VARCHAR)))), ', ') || ']'"


# =========================================================== graph jobs ====

_SHARED_E = """
e AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) || '_' || l_returnflag AS "EdgeID", l_partkey AS n,
             'Part' AS lbl, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS ship
      FROM lineitem
      WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL AND l_returnflag IS NOT NULL)"""

_SHARED_EDGES_SQL = f"""
WITH {_SHARED_E},
k AS (SELECT DISTINCT "EdgeID", n FROM e)
SELECT e.n AS "NodeID1", k.n AS "NodeID2", count(DISTINCT e."EdgeID") AS edge_weight,
       {_set_sql('e."EdgeID"')} AS "EdgeID_att",
       {_set_sql('e.l_linestatus')} AS l_linestatus_att,
       min(ship) AS ship_min, max(ship) AS ship_max
FROM e JOIN k ON e."EdgeID" = k."EdgeID" AND e.n > k.n
GROUP BY 1, 2 HAVING count(DISTINCT e."EdgeID") >= 1
"""


@register("job_shared_key_edges", _SHARED_EDGES_SQL)
def q_job_shared_key_edges(spark, sf):
    return J.shared_key_edges(table(spark, sf, "lineitem")).edges


@register("edges_from_shared_key", f"""
WITH {_SHARED_E}
SELECT a."EdgeID", a.n AS "NodeID1", a.lbl AS "Label1", a.l_linestatus, a.ship,
       b.n AS "NodeID2", b.lbl AS "Label2"
FROM e a JOIN (SELECT DISTINCT "EdgeID", n, lbl FROM e) b ON a."EdgeID" = b."EdgeID" AND a.n > b.n
""")
def q_edges_from_shared_key(spark, sf):
    detail = J.shared_key_detail(table(spark, sf, "lineitem"))
    return G.edges_from_shared_key(detail, "EdgeID", "NodeID", node_att=["Label"])


@register("filter_edges_by_threshold", f"""
WITH {_SHARED_E}
SELECT DISTINCT "EdgeID", n AS "NodeID", lbl AS "Label", l_linestatus, ship FROM e
WHERE "EdgeID" IN (SELECT "EdgeID" FROM e GROUP BY 1 HAVING count(DISTINCT n) BETWEEN 2 AND 4)
""")
def q_filter_edges_by_threshold(spark, sf):
    detail = J.shared_key_detail(table(spark, sf, "lineitem"))
    return G.filter_edges_by_threshold(detail, "NodeID", ["EdgeID"], 2, 4)


_DIRECTED_D = """
d AS (SELECT l.l_suppkey AS id1, s.s_name AS name1, o.o_custkey AS id2, c.c_name AS name2,
             l.l_orderkey, o.o_orderstatus, strftime(o.o_orderdate, '%Y-%m-%d') AS order_date
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
      LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
      LEFT JOIN customer c ON c.c_custkey = o.o_custkey
      WHERE o.o_custkey IS NOT NULL AND l.l_suppkey IS NOT NULL)"""


def _directed_edges_sql(min_edges: int) -> str:
    return f"""
WITH {_DIRECTED_D}
SELECT id1 AS "NodeID1", id2 AS "NodeID2", count(DISTINCT l_orderkey) AS edge_weight,
       {_set_sql('l_orderkey')} AS l_orderkey_att,
       {_set_sql('o_orderstatus')} AS o_orderstatus_att,
       {_set_sql('order_date')} AS order_date_att,
       min(order_date) AS order_date_min, max(order_date) AS order_date_max
FROM d GROUP BY 1, 2 HAVING count(DISTINCT l_orderkey) >= {min_edges}"""


@register("weighted_edges", _directed_edges_sql(1))
def q_weighted_edges(spark, sf):
    li, o, s, c = tables(spark, sf, "lineitem", "orders", "supplier", "customer")
    return J.directed_edges(li, o, s, c, min_edges=1).edges


@register("job_directed_edges", _directed_edges_sql(2))
def q_job_directed_edges(spark, sf):
    li, o, s, c = tables(spark, sf, "lineitem", "orders", "supplier", "customer")
    return J.directed_edges(li, o, s, c, min_edges=2).edges


_GRAPH_NODES_SQL = f"""
WITH {_DIRECTED_D},
k AS (SELECT id1, id2 FROM d GROUP BY 1, 2 HAVING count(DISTINCT l_orderkey) >= 2)
SELECT DISTINCT id1 AS "NodeID", name1 AS "NodeName", 'Supplier' AS "Label" FROM d WHERE id1 IN (SELECT id1 FROM k)
UNION
SELECT DISTINCT id2, name2, 'Customer' FROM d WHERE id2 IN (SELECT id2 FROM k)
"""


@register("graph_nodes", _GRAPH_NODES_SQL)
def q_graph_nodes(spark, sf):
    li, o, s, c = tables(spark, sf, "lineitem", "orders", "supplier", "customer")
    return J.directed_edges(li, o, s, c, min_edges=2).nodes


@register("endpoint_nodes", f"""
WITH {_DIRECTED_D}
SELECT id1 AS "NodeID", name1 AS "NodeName", 'Supplier' AS "Label" FROM d
UNION
SELECT id2, name2, 'Customer' FROM d
""")
def q_endpoint_nodes(spark, sf):
    li, o, s, c = tables(spark, sf, "lineitem", "orders", "supplier", "customer")
    detail = (J.order_events(li, o)
              .join(s.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("NodeName1")),
                    on="l_suppkey", how="left")
              .join(c.select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("NodeName2")),
                    on="o_custkey", how="left")
              .transform(Fl.dropna, subset=["o_custkey", "l_suppkey"])
              .withColumnsRenamed({"l_suppkey": "NodeID1", "o_custkey": "NodeID2"})
              .withColumns({"Label1": F.lit("Supplier"), "Label2": F.lit("Customer")}))
    return G.endpoint_nodes(detail, {"NodeID1": ["NodeName1", "Label1"], "NodeID2": ["NodeName2", "Label2"]})


_BIPARTITE_SQL = f"""
SELECT s_suppkey AS "NodeID1", s_nationkey AS "NodeID2", count(DISTINCT e) AS edge_weight,
       {_set_sql('e')} AS "EdgeID_att"
FROM (SELECT DISTINCT s_suppkey, s_name, s_nationkey, n_name,
             CAST(s_suppkey AS VARCHAR) || '_' || CAST(s_nationkey AS VARCHAR) AS e
      FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey
      WHERE s_suppkey IS NOT NULL AND s_nationkey IS NOT NULL)
GROUP BY 1, 2
"""


@register("job_bipartite_edges", _BIPARTITE_SQL)
def q_job_bipartite_edges(spark, sf):
    s, n = tables(spark, sf, "supplier", "nation")
    return J.bipartite_edges(s, n).edges


def _graph_tables(spark, sf):
    names = ("lineitem", "orders", "supplier", "customer", "nation")
    return dict(zip(names, tables(spark, sf, *names)))


_NODE_COUNTS_SQL = f"""
WITH {_DIRECTED_D},
{_SHARED_E},
k AS (SELECT id1, id2 FROM d GROUP BY 1, 2 HAVING count(DISTINCT l_orderkey) >= 2),
sk AS (SELECT DISTINCT a.n AS n1, b.n AS n2 FROM e a JOIN e b ON a."EdgeID" = b."EdgeID" AND a.n > b.n),
sn AS (SELECT DISTINCT s_suppkey AS id1, s_name AS name1, s_nationkey AS id2, n_name AS name2
       FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey
       WHERE s_suppkey IS NOT NULL AND s_nationkey IS NOT NULL),
nodes AS (
  SELECT DISTINCT id1 AS id, name1 AS name, 'Supplier' AS label FROM d WHERE id1 IN (SELECT id1 FROM k)
  UNION ALL SELECT DISTINCT id2, name2, 'Customer' FROM d WHERE id2 IN (SELECT id2 FROM k)
  UNION ALL SELECT DISTINCT n1, NULL, 'Part' FROM sk
  UNION ALL SELECT DISTINCT n2, NULL, 'Part' FROM sk
  UNION ALL SELECT DISTINCT id1, name1, 'Supplier' FROM sn
  UNION ALL SELECT DISTINCT id2, name2, 'Nation' FROM sn)"""


@register("job_graph_summary", f"""
{_NODE_COUNTS_SQL}
SELECT 'relationship' AS kind, 'supplies' AS name, (SELECT count(*) FROM k) AS n_rows
UNION ALL SELECT 'relationship', 'bought_with', (SELECT count(*) FROM sk)
UNION ALL SELECT 'relationship', 'based_in', (SELECT count(*) FROM (SELECT DISTINCT id1, id2 FROM sn))
UNION ALL SELECT 'node', label, count(*) FROM (
  SELECT * FROM nodes WHERE label <> 'Part'
  UNION ALL SELECT * FROM (SELECT DISTINCT id, name, label FROM nodes WHERE label = 'Part')) GROUP BY label
""")
def q_job_graph_summary(spark, sf):
    return J.graph_summary(J.whole_graph(_graph_tables(spark, sf)))


# ------------------------------------------------------------ node ops -----

def _people_nodes(spark, sf):
    c, s, n = tables(spark, sf, "customer", "supplier", "nation")
    cust = c.select(F.col("c_custkey").alias("NodeID"), F.lit("Customer").alias("Label"),
                    F.col("c_name").alias("NodeName"), "c_mktsegment")
    supp = s.select(F.col("s_suppkey").alias("NodeID"), F.lit("Supplier").alias("Label"),
                    F.col("s_name").alias("NodeName"), "s_acctbal")
    nat = n.select(F.col("n_nationkey").alias("NodeID"), F.lit("Nation").alias("Label"),
                   F.col("n_name").alias("NodeName"))
    return G.merge_nodes([cust, supp, nat])


_PEOPLE_SQL = """
people AS (
  SELECT c_custkey AS "NodeID", 'Customer' AS "Label", c_name AS "NodeName", c_mktsegment FROM customer
  UNION ALL BY NAME SELECT s_suppkey AS "NodeID", 'Supplier' AS "Label", s_name AS "NodeName", s_acctbal FROM supplier
  UNION ALL BY NAME SELECT CAST(n_nationkey AS BIGINT) AS "NodeID", 'Nation' AS "Label", n_name AS "NodeName" FROM nation)"""


@register("merged_nodes", f"""
WITH {_PEOPLE_SQL}
SELECT "Label", "NodeID", "NodeName", c_mktsegment, s_acctbal FROM people
""")
def q_merged_nodes(spark, sf):
    return _people_nodes(spark, sf)


@register("nodes_for_label", """
SELECT DISTINCT 'Supplier' AS ":LABEL", s_suppkey AS "SUPPLIER:ID", s_name AS "NodeName", s_acctbal FROM supplier
""")
def q_nodes_for_label(spark, sf):
    return G.nodes_for_label(_people_nodes(spark, sf), "Supplier")


@register("unique_nodes", """
SELECT "Label", "NodeID", min("NodeName") AS "NodeName" FROM (
  SELECT 'Customer' AS "Label", c_custkey AS "NodeID", c_name AS "NodeName" FROM customer
  UNION ALL
  SELECT 'Customer', c_custkey, c_mktsegment || ' customer' FROM customer)
GROUP BY 1, 2
""")
def q_unique_nodes(spark, sf):
    c = table(spark, sf, "customer")
    by_name = c.select(F.lit("Customer").alias("Label"), F.col("c_custkey").alias("NodeID"),
                       F.col("c_name").alias("NodeName"))
    by_segment = c.select(F.lit("Customer").alias("Label"), F.col("c_custkey").alias("NodeID"),
                          F.concat("c_mktsegment", F.lit(" customer")).alias("NodeName"))
    return G.unique_nodes(by_name.unionByName(by_segment), key=["Label", "NodeID"])


_G9_SQL = """
WITH ed AS (SELECT l.l_suppkey AS "NodeID1", o.o_custkey AS "NodeID2", count(DISTINCT l.l_orderkey) AS edge_weight
            FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
            WHERE o.o_custkey IS NOT NULL AND l.l_suppkey IS NOT NULL GROUP BY 1, 2),
f AS (SELECT ed.*,
        NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = ed."NodeID1") AS missing_start,
        NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = ed."NodeID2" AND c_acctbal > 0) AS missing_end
      FROM ed)"""


def _g9_inputs(spark, sf):
    li, o, s, c = tables(spark, sf, "lineitem", "orders", "supplier", "customer")
    edges = J.directed_edges(li, o, s, c, min_edges=1).edges.select("NodeID1", "NodeID2", "edge_weight")
    nodes = G.merge_nodes([
        s.select(F.col("s_suppkey").alias("NodeID"), F.lit("Supplier").alias("Label")),
        c.where(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("NodeID"), F.lit("Customer").alias("Label")),
    ])
    return edges, nodes


@register("edges_with_endpoints", _G9_SQL + """
SELECT "NodeID1", "NodeID2", edge_weight FROM f WHERE NOT missing_start AND NOT missing_end
""")
def q_edges_with_endpoints(spark, sf):
    edges, nodes = _g9_inputs(spark, sf)
    return G.edges_with_endpoints(edges, nodes, "Supplier", "Customer")


@register("dangling_edges", _G9_SQL + """
SELECT * FROM f WHERE missing_start OR missing_end
""")
def q_dangling_edges(spark, sf):
    edges, nodes = _g9_inputs(spark, sf)
    return G.dangling_edges(edges, nodes, "Supplier", "Customer")


# ============================================================ columns ======

@register("use_cols", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def q_use_cols(spark, sf):
    return C.use_cols(table(spark, sf, "customer"), ["c_name", "c_custkey", "c_acctbal"])


@register("drop_cols", "SELECT p_partkey, p_name, p_brand, p_retailprice FROM part")
def q_drop_cols(spark, sf):
    return C.drop_cols(table(spark, sf, "part"), ["p_type", "p_size", "no_such_column"])


@register("rename_cols", """
SELECT p_partkey AS "PartID", p_name AS "NodeName", p_brand, p_type, p_size, p_retailprice FROM part
""")
def q_rename_cols(spark, sf):
    return C.rename_cols(table(spark, sf, "part"),
                         {"p_partkey": "NodeID", "NodeID": "PartID", "p_name": "NodeName", "missing": "x"})


@register("add_literal", "SELECT *, 'Customer' AS \"Label\" FROM customer")
def q_add_literal(spark, sf):
    return C.add_literal(table(spark, sf, "customer"), "Label", "Customer")


@register("assign_fn", """
SELECT *, upper(c_name) AS name_upper, round(c_acctbal, 0) AS bal_round, c_acctbal * 2 AS bal_twice FROM customer
""")
def q_assign_fn(spark, sf):
    return (table(spark, sf, "customer")
            .transform(C.assign_fn, "name_upper", "upper", "c_name")
            .transform(C.assign_fn, "bal_round", "round", ["c_acctbal", 0])
            .transform(C.assign, "bal_twice", F.col("c_acctbal") * 2))


@register("astype", """
SELECT l_orderkey, l_linenumber, CAST(trunc(l_extendedprice) AS INTEGER) AS l_extendedprice,
       TRY_CAST(l_returnflag AS INTEGER) AS l_returnflag
FROM lineitem
""")
def q_astype(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag")
    return C.astype(li, "int", ["l_extendedprice", "l_returnflag"])


def _orders_with_gaps(spark, sf):
    """Orders plus a column that is always NULL and one NULL except for status 'F'."""
    return (table(spark, sf, "orders")
            .withColumn("all_null", F.lit(None).cast("string"))
            .withColumn("half_null", F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))))


@register("drop_null_cols", """
SELECT *, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS half_null FROM orders
""")
def q_drop_null_cols(spark, sf):
    return C.drop_null_cols(_orders_with_gaps(spark, sf))


@register("null_profile", """
SELECT count(*) - count(o_orderkey) AS o_orderkey, count(*) - count(o_custkey) AS o_custkey,
       count(*) - count(o_orderstatus) AS o_orderstatus, count(*) - count(o_totalprice) AS o_totalprice,
       count(*) - count(o_orderdate) AS o_orderdate, count(*) - count(o_orderpriority) AS o_orderpriority,
       count(*) AS all_null, count(*) FILTER (WHERE o_orderstatus IS DISTINCT FROM 'F' OR o_orderpriority IS NULL) AS half_null
FROM orders
""")
def q_null_profile(spark, sf):
    return C.null_profile(_orders_with_gaps(spark, sf))


@register("null_profile_footers", """
SELECT count(*) - count(doc_id) AS doc_id, count(*) - count(text) AS text, count(*) - count(lang) AS lang,
       count(*) - count(source) AS source, count(*) AS all_null
FROM documents
""")
def q_null_profile_footers(spark, sf):
    """NULLs of a stored table whose columns mostly have none: text is not read where a footer says so."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return C.null_profile(docs.withColumn("all_null", F.lit(None).cast("string")), by_column=True)


@register("drop_null_cols_footers", """
SELECT doc_id, lang, source FROM documents
""")
def q_drop_null_cols_footers(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source").withColumn("all_null", F.lit(None).cast("string"))
    return C.drop_null_cols(docs, by_column=True)


@register("order_node_ids", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_partkey > l_suppkey THEN l_partkey ELSE l_suppkey END AS l_partkey,
       CASE WHEN l_partkey > l_suppkey THEN l_suppkey ELSE l_partkey END AS l_suppkey,
       CASE WHEN l_partkey > l_suppkey THEN l_quantity ELSE l_discount END AS l_quantity,
       CASE WHEN l_partkey > l_suppkey THEN l_discount ELSE l_quantity END AS l_discount
FROM lineitem
""")
def q_order_node_ids(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                                             "l_suppkey", "l_discount")
    return C.order_node_ids(li, {"l_partkey": "l_quantity"}, {"l_suppkey": ["l_discount"]})


# ============================================================ filters ======

@register("filter_query", "SELECT * FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'")
def q_filter_query(spark, sf):
    return Fl.filter_query(table(spark, sf, "orders"), "o_totalprice > 100000 AND o_orderstatus = 'F'")


_BRANDS = ["Brand#11", "Brand#23", "Brand#5"]


@register("filter_isin", "SELECT * FROM part WHERE p_brand IN ('Brand#11', 'Brand#23', 'Brand#5')")
def q_filter_isin(spark, sf):
    return Fl.filter_isin(table(spark, sf, "part"), "p_brand", _BRANDS)


@register("filter_not_in", "SELECT * FROM part WHERE p_brand NOT IN ('Brand#11', 'Brand#23', 'Brand#5')")
def q_filter_not_in(spark, sf):
    return Fl.filter_isin(table(spark, sf, "part"), "p_brand", _BRANDS, not_in=True)


@register("filter_length", """
SELECT doc_id, lang, n_chars FROM documents WHERE length(text) BETWEEN 200 AND 2000
""")
def q_filter_length(spark, sf):
    return Fl.filter_length(table(spark, sf, "documents"), "text", 200, 2000).select("doc_id", "lang", "n_chars")


@register("filter_has_digits", "SELECT doc_id, source FROM documents WHERE regexp_matches(text, '[0-9]')")
def q_filter_has_digits(spark, sf):
    return Fl.filter_has_digits(table(spark, sf, "documents"), "text").select("doc_id", "source")


def _docs_labels(spark, sf):
    d, lab = tables(spark, sf, "documents", "labels")
    return d.select("doc_id", "lang", "source").join(lab, on="doc_id", how="left")


_DOCS_LABELS = """
dl AS (SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


@register("dropna", f"WITH {_DOCS_LABELS} SELECT * FROM dl WHERE quality IS NOT NULL AND toxic IS NOT NULL")
def q_dropna(spark, sf):
    return Fl.dropna(_docs_labels(spark, sf), how="any", subset=["quality", "toxic"])


@register("fillna", f"""
WITH {_DOCS_LABELS}
SELECT doc_id, lang, source, coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic FROM dl
""")
def q_fillna(spark, sf):
    return Fl.fillna(_docs_labels(spark, sf), {"quality": -1, "toxic": 0})


@register("replace_values", f"""
WITH {_DOCS_LABELS}
SELECT doc_id, CASE lang WHEN 'en' THEN 'english' WHEN 'fr' THEN 'french' ELSE lang END AS lang,
       source, quality, toxic FROM dl
""")
def q_replace_values(spark, sf):
    return Fl.replace_values(_docs_labels(spark, sf), {"en": "english", "fr": "french"}, subset=["lang"])


@register("dedup_all", "SELECT DISTINCT l_orderkey, l_partkey FROM lineitem")
def q_dedup_all(spark, sf):
    return Fl.drop_duplicates(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey"))


@register("dedup_subset", """
SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber NULLS FIRST, l_quantity NULLS FIRST) = 1
""")
def q_dedup_subset(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    return Fl.drop_duplicates(li, subset=["l_orderkey", "l_partkey"], order_by=["l_linenumber"])


@register("last_window", """
SELECT * FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 4 HOURS
""")
def q_last_window(spark, sf):
    return Fl.latest_window(table(spark, sf, "events"), "ts", hours=4)


@register("time_range", """
SELECT event_id, ts, event_type FROM events
WHERE ts > TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-12 12:00:00'
""")
def q_time_range(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts", "event_type")
    return Fl.time_range(ev, "ts", F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"),
                         F.lit("2024-01-12 12:00:00").cast("timestamp_ntz"))


@register("row_count", "SELECT count(*) AS n_rows FROM orders")
def q_row_count(spark, sf):
    return R.row_count(table(spark, sf, "orders"))


@register("peek", "SELECT * FROM events ORDER BY ts DESC, event_id LIMIT 5")
def q_peek(spark, sf):
    return Fl.peek(table(spark, sf, "events"), 5, order_by=[F.col("ts").desc(), F.col("event_id")])


@register("sample_keys", """
SELECT * FROM orders WHERE o_custkey IN
  (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL ORDER BY o_custkey LIMIT 10)
""")
def q_sample_keys(spark, sf):
    return Fl.sample_keys(table(spark, sf, "orders"), "o_custkey", 10)


# ============================================================== joins ======

def _cust_orders(spark, sf):
    c, o = tables(spark, sf, "customer", "orders")
    return c, o.withColumnRenamed("o_custkey", "c_custkey")


@register("join_inner", """
SELECT DISTINCT c.*, o.o_orderkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority
FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey
""")
def q_join_inner(spark, sf):
    c, o = _cust_orders(spark, sf)
    return R.join_df(c, o, "c_custkey", "inner")


# The other join kinds run on sides with rows that have no partner and rows with a NULL key.

def _null_every(col: str, n: int):
    return F.when(F.col(col) % n != 0, F.col(col))


@register("join_left", """
SELECT DISTINCT p.k AS p_partkey, p.p_name, l.l_orderkey, l.l_quantity
FROM (SELECT CASE WHEN p_partkey % 7 <> 0 THEN p_partkey END AS k, p_name FROM part) p
LEFT JOIN (SELECT CASE WHEN l_partkey % 5 <> 0 THEN l_partkey END AS k, l_orderkey, l_quantity FROM lineitem) l ON p.k = l.k
""")
def q_join_left(spark, sf):
    p, li = tables(spark, sf, "part", "lineitem")
    lines = li.select(_null_every("l_partkey", 5).alias("p_partkey"), "l_orderkey", "l_quantity")
    return R.join_df(p.select(_null_every("p_partkey", 7).alias("p_partkey"), "p_name"), lines, "p_partkey", "left")


def _supp_nation(spark, sf):
    s, n = tables(spark, sf, "supplier", "nation")
    return s.select("s_suppkey", "s_name", F.col("s_nationkey").alias("n_nationkey")), n


@register("join_right", """
SELECT DISTINCT n.k AS n_nationkey, s.s_suppkey, s.s_name, n.n_name, n.n_regionkey
FROM supplier s
RIGHT JOIN (SELECT CASE WHEN n_nationkey % 5 <> 0 THEN n_nationkey END AS k, n_name, n_regionkey FROM nation) n ON s.s_nationkey = n.k
""")
def q_join_right(spark, sf):
    s, n = _supp_nation(spark, sf)
    n = n.select(_null_every("n_nationkey", 5).alias("n_nationkey"), "n_name", "n_regionkey")
    return R.join_df(s, n, "n_nationkey", "right")


@register("join_cross_keyed", """
SELECT DISTINCT n.n_nationkey, s.s_suppkey, s.s_name, n.n_name, n.n_regionkey
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
""")
def q_join_cross_keyed(spark, sf):
    s, n = _supp_nation(spark, sf)
    return R.join_df(s, n, "n_nationkey", "cross")


@register("join_full", """
SELECT DISTINCT coalesce(d.k, l.k) AS doc_id, d.lang, l.quality, l.toxic
FROM (SELECT CASE WHEN doc_id % 11 <> 0 THEN doc_id END AS k, lang FROM documents) d
FULL OUTER JOIN (SELECT CASE WHEN doc_id % 13 <> 0 THEN doc_id END AS k, quality, toxic FROM labels) l ON d.k = l.k
""")
def q_join_full(spark, sf):
    d, lab = tables(spark, sf, "documents", "labels")
    d = d.select(_null_every("doc_id", 11).alias("doc_id"), "lang")
    return R.join_df(d, lab.select(_null_every("doc_id", 13).alias("doc_id"), "quality", "toxic"), "doc_id", "full")


_KEYED_ORDERS = "SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_custkey % 3 <> 0"


@register("join_semi", f"SELECT * FROM customer c WHERE EXISTS ({_KEYED_ORDERS})")
def q_join_semi(spark, sf):
    c, o = _cust_orders(spark, sf)
    return R.join_df(c, o.withColumn("c_custkey", _null_every("c_custkey", 3)), "c_custkey", "left_semi")


@register("join_anti", f"SELECT * FROM customer c WHERE NOT EXISTS ({_KEYED_ORDERS})")
def q_join_anti(spark, sf):
    c, o = _cust_orders(spark, sf)
    return R.join_df(c, o.withColumn("c_custkey", _null_every("c_custkey", 3)), "c_custkey", "left_anti")


# ===================================================== cached steps =======

@register("cached_step", """
SELECT 'status' AS by, o_orderstatus AS name, count(*) AS n_rows, count(DISTINCT c_nationkey) AS n_nations
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY o_orderstatus
UNION ALL
SELECT 'priority', o_orderpriority, count(*), count(DISTINCT c_nationkey)
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY o_orderpriority
""")
def q_cached_step(spark, sf):
    """One joined step, cached on request, feeds two aggregates; the scope gives the memory back."""
    c, o = tables(spark, sf, "customer", "orders")
    with scratch_scope(spark) as scope:
        joined = cache(o.join(c.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
                       .select("o_orderstatus", "o_orderpriority", "c_nationkey"))

        def counts(by, col):
            return joined.groupBy(F.lit(by).alias("by"), F.col(col).alias("name")).agg(
                F.count(F.lit(1)).alias("n_rows"), F.count_distinct("c_nationkey").alias("n_nations"))

        return scope.keep(counts("status", "o_orderstatus").unionByName(counts("priority", "o_orderpriority")), "cached-step")


# ============================================================ unions =======

def _parties(spark, sf):
    c, s = tables(spark, sf, "customer", "supplier")
    cust = c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                    F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"), "c_mktsegment")
    supp = s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                    F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    return cust, supp


@register("union_by_name", """
SELECT acctbal, c_mktsegment, id, name, nationkey FROM (
  SELECT c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment FROM customer
  UNION ALL BY NAME
  SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal FROM supplier)
""")
def q_union_by_name(spark, sf):
    return R.union_by_name(*_parties(spark, sf))


@register("union_tagged", """
SELECT 'customer' AS kind, c_custkey AS id, c_name AS name, c_nationkey AS nationkey FROM customer
UNION ALL
SELECT 'supplier', s_suppkey, s_name, s_nationkey FROM supplier
""")
def q_union_tagged(spark, sf):
    cust, supp = _parties(spark, sf)
    cols = ["id", "name", "nationkey"]
    return R.union_tagged([({"kind": "customer"}, cust.select(*cols)), ({"kind": "supplier"}, supp.select(*cols))])


# ======================================================= scalar funcs ======

@register("concat_cols", """
SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) || '_' || o_orderstatus || '_' || o_orderpriority AS "EdgeID" FROM orders
""")
def q_concat_cols(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return C.concat_cols(o, "EdgeID", ["o_orderkey", "o_orderstatus", "o_orderpriority"], "_") \
        .select("o_orderkey", "EdgeID")


@register("lpad_id", """
SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS key5, lpad(CAST(c_custkey AS VARCHAR), 3, '#') AS key3
FROM customer
""")
def q_lpad_id(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    return c.transform(C.lpad_col, "key5", "c_custkey", 5, "0").transform(C.lpad_col, "key3", "c_custkey", 3, "#")


@register("clean_text", r"""
SELECT doc_id, regexp_replace(text, '[^0-9a-zA-Zא-ת ]', '', 'g') AS text FROM documents
""")
def q_clean_text(spark, sf):
    return C.clean_cols(table(spark, sf, "documents").select("doc_id", "text"), ["text"])


@register("stringify", """
SELECT o_orderkey, '[' || array_to_string(string_split(o_orderpriority, '-'), ',') || ']' AS priority_set,
       '[' || o_orderstatus || ']' AS status_att
FROM orders
""")
def q_stringify(spark, sf):
    o = table(spark, sf, "orders")
    arrays = o.select("o_orderkey", F.split("o_orderpriority", "-").alias("priority_set"),
                      F.array("o_orderstatus").alias("status_att"))
    return C.auto_stringify(arrays)


def _dated_orders(spark, sf):
    o = table(spark, sf, "orders")
    text = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    return o.select("o_orderkey", text.alias("order_day"))


@register("parse_date", """
SELECT o_orderkey,
       strftime(try_strptime(CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE strftime(o_orderdate, '%d/%m/%Y') END,
                             '%d/%m/%Y'), '%Y-%m-%d') AS order_day
FROM orders
""")
def q_parse_date(spark, sf):
    parsed = C.to_date_cols(_dated_orders(spark, sf), ["order_day"])
    return parsed.select("o_orderkey", F.date_format("order_day", "yyyy-MM-dd").alias("order_day"))


def _stamped_events(spark, sf):
    ev = table(spark, sf, "events")
    text = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return ev.select("event_id", text.alias("ts_text"))


_STAMPED_SQL = """
s AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts_text
      FROM events)"""


@register("parse_timestamp", f"""
WITH {_STAMPED_SQL} SELECT event_id, try_strptime(ts_text, '%Y-%m-%d %H:%M:%S') AS ts_text FROM s
""")
def q_parse_timestamp(spark, sf):
    return C.to_timestamp_cols(_stamped_events(spark, sf), ["ts_text"], "yyyy-MM-dd HH:mm:ss", ntz=True)


@register("parse_epoch", f"""
WITH {_STAMPED_SQL} SELECT event_id, CAST(epoch(try_strptime(ts_text, '%Y-%m-%d %H:%M:%S')) AS BIGINT) AS ts_text FROM s
""")
def q_parse_epoch(spark, sf):
    return C.to_epoch_cols(_stamped_events(spark, sf), ["ts_text"], "yyyy-MM-dd HH:mm:ss")


# ====================================================== sources/sinks ======

@register("read_csv_schema", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_read_csv_schema(spark, sf):
    base = scratch_path(spark, "read_csv_schema")
    K.save_file(table(spark, sf, "customer"), base, "customer", fmt="csv",
                options={"header": "true", "sep": "|"})
    return S.read_file(spark, f"{base}/customer",
                       dtype=[["c_custkey", "bigint"], ["c_name", "string"], ["c_nationkey", "int"],
                              ["c_acctbal", "double"], ["c_mktsegment", "string"]],
                       fmt="csv", options=S.EXPORT_CSV_OPTIONS)


@register("read_by_prefix", """
SELECT 'Customer' AS kind, count(*) AS n_rows, count(DISTINCT c_name) AS n_names FROM customer
UNION ALL SELECT 'Supplier', count(*), count(DISTINCT s_name) FROM supplier
""")
def q_read_by_prefix(spark, sf):
    base = scratch_path(spark, "read_by_prefix")
    c, s = tables(spark, sf, "customer", "supplier")
    c.write.parquet(f"{base}/CustomerDoc_2024")
    s.write.parquet(f"{base}/SupplierDoc_2024")
    typed = S.read_by_prefix(spark, base, ["Customer", "Supplier"])
    return typed.groupBy("kind").agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.count_distinct(F.coalesce("c_name", "s_name")).alias("n_names"))


def _directed_export(spark, sf):
    li, o, s, c = tables(spark, sf, "lineitem", "orders", "supplier", "customer")
    edges = J.directed_edges(li, o, s, c, min_edges=2).edges
    return K.write_edges(edges, scratch_path(spark, "directed"), "supplies")


_HEADER = ("NodeID1:START_ID|NodeID2:END_ID|edge_weight|l_orderkey_att|o_orderstatus_att|order_date_att|"
           "order_date_min|order_date_max")


@register("roundtrip_edges_csv", f"""
WITH x AS ({_directed_edges_sql(2)})
SELECT CAST("NodeID1" AS VARCHAR) AS "NodeID1:START_ID", CAST("NodeID2" AS VARCHAR) AS "NodeID2:END_ID",
       CAST(edge_weight AS VARCHAR) AS edge_weight, l_orderkey_att, o_orderstatus_att, order_date_att,
       order_date_min, order_date_max FROM x
""")
def q_roundtrip_edges_csv(spark, sf):
    return K.read_export(spark, _directed_export(spark, sf))


@register("header_row", f"""
WITH x AS ({_directed_edges_sql(2)})
SELECT '{_HEADER}' AS header, 8 AS n_header_fields, count(*) AS n_rows, 8 AS min_fields, 8 AS max_fields FROM x
""")
def q_header_row(spark, sf):
    entry = _directed_export(spark, sf)
    header = spark.read.text(entry["header"]).select(F.col("value").alias("header"))
    # one pass over the written parts; the one-row result joins the header row as a
    # scalar subquery (no join)
    stats = (spark.read.text(entry["data"])
             .select(F.size(F.split("value", r"\|")).alias("n"))
             .agg(F.struct(F.count(F.lit(1)).alias("n_rows"), F.min("n").alias("min_fields"),
                           F.max("n").alias("max_fields")))
             .scalar())
    return header.select("header", F.size(F.split("header", r"\|")).alias("n_header_fields"),
                         stats["n_rows"].alias("n_rows"), stats["min_fields"].alias("min_fields"),
                         stats["max_fields"].alias("max_fields"))


@register("roundtrip_nodes_csv", f"""
WITH {_DIRECTED_D},
k AS (SELECT id1, id2 FROM d GROUP BY 1, 2 HAVING count(DISTINCT l_orderkey) >= 2)
SELECT DISTINCT 'Customer' AS export, 'CUSTOMER:ID|NodeName|:LABEL' AS header, CAST(id2 AS VARCHAR) AS id,
       name2 AS name, 'Customer' AS label FROM d WHERE id2 IN (SELECT id2 FROM k)
UNION ALL
SELECT DISTINCT 'Supplier', 'SUPPLIER:ID|NodeName|:LABEL', CAST(id1 AS VARCHAR), name1, 'Supplier'
FROM d WHERE id1 IN (SELECT id1 FROM k)
""")
def q_roundtrip_nodes_csv(spark, sf):
    li, o, s, c = tables(spark, sf, "lineitem", "orders", "supplier", "customer")
    nodes = J.directed_edges(li, o, s, c, min_edges=2).nodes
    written = K.write_nodes(nodes, scratch_path(spark, "nodes"))
    parts = []
    for e in written:
        back = K.read_export(spark, e)
        id_col = next(c for c in back.columns if c.endswith(G.ID_SUFFIX) and c != G.LABEL_HEADER)
        parts.append(back.select(F.lit(e["name"]).alias("export"), F.lit("|".join(back.columns)).alias("header"),
                                 F.col(id_col).alias("id"), F.col("NodeName").alias("name"),
                                 F.col(G.LABEL_HEADER).alias("label")))
    return R.union_all_by_name(parts)


@register("import_manifest", f"""
{_NODE_COUNTS_SQL}
SELECT 'relationship' AS kind, 'supplies' AS name, 'supplies_header' AS header_path,
       'supplies_edges/part-*' AS part_glob, (SELECT count(*) FROM k) AS row_count
UNION ALL SELECT 'relationship', 'bought_with', 'bought_with_header', 'bought_with_edges/part-*', (SELECT count(*) FROM sk)
UNION ALL SELECT 'relationship', 'based_in', 'based_in_header', 'based_in_edges/part-*',
                 (SELECT count(*) FROM (SELECT DISTINCT id1, id2 FROM sn))
UNION ALL SELECT 'node', label, 'nodes/' || label || '_header', 'nodes/' || label || '/part-*', count(*)
FROM (SELECT DISTINCT id, name, label FROM nodes) GROUP BY label
""")
def q_import_manifest(spark, sf):
    base = scratch_path(spark, "graph")
    return K.import_manifest(spark, J.export_whole_graph(_graph_tables(spark, sf), base), base)


# ============================================================ nested =======

def _nested_lineups(spark, sf) -> DataFrame:
    """Lineitem as nested lineups: one match per order, in it a team per return
    flag with all its parts as players (country: the supplier's nation)."""
    li, s, p, n = tables(spark, sf, "lineitem", "supplier", "part", "nation")
    rows = (li.select("l_orderkey", "l_suppkey", "l_partkey", "l_returnflag")
            .join(s.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey", "left")
            .join(p.select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey", "left")
            .join(n.select(F.col("n_nationkey").alias("s_nationkey"), "n_name"), "s_nationkey", "left"))
    player = F.struct(F.col("l_partkey").alias("player_id"), F.col("p_name").alias("player_name"),
                      F.when(F.col("n_name").isNotNull(), F.struct(F.col("n_name").alias("name"))).alias("country"))
    # both groupings run where the rows of an order are: plain rows are shuffled once, no nested ones
    teams = rows.repartition("l_orderkey").groupBy("l_orderkey", "l_returnflag").agg(F.collect_list(player).alias("lineup"))
    team = F.struct(F.ascii("l_returnflag").cast("bigint").alias("team_id"), F.col("l_returnflag").alias("team_name"), "lineup")
    return (teams.groupBy(F.col("l_orderkey").alias("match_id"))
            .agg(F.map_from_entries(F.collect_list(F.struct("l_returnflag", team.alias("team")))).alias("lineups")))


def _lineup_json(spark, sf) -> str:
    """Write the nested lineups as JSON, packed: the text repeats every field name for each player."""
    path = scratch_path(spark, "lineups")
    _nested_lineups(spark, sf).write.option("compression", "gzip").json(path)
    return path


_LINEUP_READ_SCHEMA = f"match_id BIGINT, lineups {N.LINEUP_SCHEMA}"

_FLAT_LINEUP_SQL = """
fl AS (SELECT l.l_orderkey AS match_id, CAST(ascii(l.l_returnflag) AS BIGINT) AS team_id, l.l_returnflag AS team_name, l.l_partkey AS player_id,
              p.p_name AS player_name, coalesce(n.n_name, '') AS country
       FROM lineitem l LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
       LEFT JOIN part p ON p.p_partkey = l.l_partkey LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey)"""


def _flat_lineup(spark, sf):
    raw = S.read_file(spark, _lineup_json(spark, sf), dtype=_LINEUP_READ_SCHEMA, fmt="json")
    return N.flatten_lineup(raw, "lineups", keep=["match_id"])


@register("flatten_lineup", f"WITH {_FLAT_LINEUP_SQL} SELECT * FROM fl")
def q_flatten_lineup(spark, sf):
    return _flat_lineup(spark, sf)


@register("enrich_joins", f"""
WITH {_FLAT_LINEUP_SQL}
SELECT fl.*, strftime(o.o_orderdate, '%Y-%m-%d') AS match_date, o.o_custkey, c.c_name, c.c_mktsegment
FROM fl LEFT JOIN orders o ON o.o_orderkey = fl.match_id LEFT JOIN customer c ON c.c_custkey = o.o_custkey
""")
def q_enrich_joins(spark, sf):
    o, c = tables(spark, sf, "orders", "customer")
    matches = o.select(F.col("o_orderkey").alias("match_id"),
                       F.date_format("o_orderdate", "yyyy-MM-dd").alias("match_date"), "o_custkey")
    comps = c.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return R.enrich(_flat_lineup(spark, sf), [(matches, "match_id"), (comps, "o_custkey")])


_EVENT_SCHEMA = ("type STRING, player BIGINT, pass STRUCT<recipient: STRUCT<id: INT, name: STRING>, length: DOUBLE, "
                 "type: STRUCT<name: STRING>>")


def _nested_events(spark, sf) -> DataFrame:
    """Events as nested JSON text: clicks carry a ``pass`` object (a third of them with a
    type), other events none."""
    ev = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    pass_ = F.when(F.col("event_type") == "click",
                   F.struct(F.struct(k.alias("id"), F.concat(F.lit("user "), k).alias("name")).alias("recipient"),
                            F.col("value").alias("length"),
                            F.when(k % 3 == 0, F.struct(F.lit("Corner").alias("name"))).alias("type")))
    body = F.to_json(F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("player"),
                              pass_.alias("pass")))
    return ev.select("event_id", body.alias("event"))


@register("flatten_events", """
WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
SELECT event_id, event_type AS type, user_id AS player, k AS recipient_id, 'user ' || k AS recipient_name, value AS length,
       CASE WHEN k % 3 = 0 THEN 'Corner' END AS pass_type
FROM e WHERE event_type = 'click'
""")
def q_flatten_events(spark, sf):
    flat = N.extract_fields(_nested_events(spark, sf), "event", _EVENT_SCHEMA,
                            {"type": "type", "player": "player", "recipient_id": "pass.recipient.id",
                             "recipient_name": "pass.recipient.name", "length": "pass.length",
                             "pass_type": "pass.type.name"}, keep=["event_id"])
    return Fl.filter_query(flat, F.col("type") == "click")


@register("parse_with_rejects", """
SELECT event_id,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
       CASE WHEN event_type = 'error' THEN 'rejected' ELSE 'ok' END AS status
FROM events
""")
def q_parse_with_rejects(spark, sf):
    ev = table(spark, sf, "events")
    # error events carry a corrupted record ("k"= 69 instead of "k": 69)
    raw = ev.select("event_id", F.when(F.col("event_type") == "error", F.regexp_replace("props", ":", "="))
                    .otherwise(F.col("props")).alias("props"))
    good, rejected = N.parse_with_rejects(raw, "props", "k INT", keep=["event_id"])
    return (good.select("event_id", "k", F.lit("ok").alias("status"))
            .unionByName(rejected.select("event_id", F.lit(None).cast("int").alias("k"),
                                         F.lit("rejected").alias("status"))))


def _break_files(spark, folder: str, keep: float) -> None:
    """Cut every data file of a folder off after a part of its length."""
    for r in spark.read.format("binaryFile").load(folder).select("path", "content").toLocalIterator():
        K._write_bytes(spark, r["path"], bytes(r["content"][:int(len(r["content"]) * keep)]))


@register("whole_files", """
SELECT 'parquet' AS kind, 'rows' AS what, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS id_sum FROM orders
WHERE o_orderstatus <> 'F' UNION ALL
SELECT 'gzip', 'rows', count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer WHERE c_nationkey % 5 <> 2 UNION ALL
SELECT 'parquet', 'cut off', 1, 0 UNION ALL SELECT 'parquet', 'schema: no column o_orderkey', 1, 0 UNION ALL
SELECT 'gzip', 'cut off', 1, 0
""")
def q_whole_files(spark, sf):
    """One input per order status and per nation group; a broken and a foreign one among them are left out whole."""
    base = scratch_path(spark, "whole-files")
    o, c, n = tables(spark, sf, "orders", "customer", "nation")
    o.write.partitionBy("o_orderstatus").parquet(f"{base}/orders")
    n.write.parquet(f"{base}/orders/o_orderstatus=N")
    (c.select("c_custkey", "c_name", (F.col("c_nationkey") % 5).alias("group")).write.partitionBy("group")
     .options(header="true", compression="gzip").csv(f"{base}/customers"))
    _break_files(spark, f"{base}/orders/o_orderstatus=F", 0.6)
    _break_files(spark, f"{base}/customers/group=2", 0.9)
    found = [("parquet", "o_orderkey", *S.read_whole_files(spark, f"{base}/orders/*", "o_orderkey BIGINT, o_totalprice DOUBLE")),
             ("gzip", "c_custkey", *S.read_whole_files(spark, f"{base}/customers/*", "c_custkey BIGINT, c_name STRING", "csv", {"header": "true"}))]
    out = []
    for kind, key, rows, rejects in found:
        out.append(rows.agg(F.count(F.lit(1)).alias("n"), F.sum(key).alias("id_sum")).select(F.lit(kind).alias("kind"), F.lit("rows").alias("what"), "n", "id_sum"))
        # inputs, not files: how many files an input has depends on the machine
        told = F.when(F.col("reason").startswith("unreadable"), "cut off").otherwise(F.col("reason"))
        out.append(rejects.groupBy(told.alias("what")).agg(F.count_distinct(F.regexp_replace("file", "/[^/]*$", "")).alias("n"))
                   .select(F.lit(kind), "what", "n", F.lit(0).cast("bigint")))
    return out[0].union(out[1]).union(out[2]).union(out[3])


@register("player_lookup", """
WITH en AS (SELECT l_orderkey, p_brand, l_partkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS rnk
            FROM lineitem JOIN part ON p_partkey = l_partkey),
lk AS (SELECT l_orderkey, p_brand, l_partkey AS resolved_id FROM en
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, p_brand ORDER BY rnk DESC, l_linenumber DESC, l_partkey DESC) = 1)
SELECT en.l_orderkey, en.l_linenumber, en.p_brand, lk.resolved_id
FROM en JOIN lk ON en.l_orderkey = lk.l_orderkey AND en.p_brand = lk.p_brand
""")
def q_player_lookup(spark, sf):
    li, p = tables(spark, sf, "lineitem", "part")
    entries = li.select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag") \
        .join(p.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), on="l_partkey", how="inner")
    player = F.struct(F.col("l_partkey").alias("id"), F.col("p_brand").alias("name"))
    # nested events of a match: one per substitute (R lines), one with the line-up (all other lines)
    subs = entries.where(F.col("l_returnflag") == "R").select(
        "l_orderkey", F.col("l_linenumber").alias("at"),
        F.to_json(F.struct(F.struct(player.alias("replacement")).alias("substitution"))).alias("event"))
    in_order = F.array_sort(F.collect_list(F.struct("l_linenumber", F.struct(player.alias("player")).alias("entry"))))
    lineups = (entries.where(F.col("l_returnflag") != "R").groupBy("l_orderkey")
               .agg(F.transform(in_order, lambda x: x["entry"]).alias("lineup"))
               .select("l_orderkey", F.lit(0).alias("at"),
                       F.to_json(F.struct(F.struct("lineup").alias("tactics"))).alias("event")))
    sources = N.event_players(subs.unionByName(lineups), "event", ["l_orderkey"], "at")
    lookup = (N.lookup_last_wins(sources, ["l_orderkey"], "name", "id", "position")
              .withColumnsRenamed({"name": "p_brand", "id": "resolved_id"}))
    passes = entries.select("l_orderkey", "l_linenumber", "p_brand")
    return R.join_df(passes, lookup, ["l_orderkey", "p_brand"], "inner", distinct=False) \
        .select("l_orderkey", "l_linenumber", "p_brand", "resolved_id")


# player names as they should not be: line breaks, outer spaces, quotes, separators, empty and missing
_AWKWARD_SQL = """CASE player_id % 7 WHEN 0 THEN player_name || chr(10) || 'x' WHEN 1 THEN ' ' || player_name || ' '
       WHEN 2 THEN '' WHEN 3 THEN NULL WHEN 4 THEN player_name || '|"' WHEN 5 THEN chr(92) || player_name ELSE player_name END"""


@register("export_flat_inputs", f"""
WITH {_FLAT_LINEUP_SQL},
a AS (SELECT player_id, {_AWKWARD_SQL} AS name FROM fl)
SELECT 'lineups' AS export, count(*) AS n_rows, count(DISTINCT name) AS n_names, CAST(sum(player_id) AS BIGINT) AS id_sum,
       count(*) - count(name) AS n_null, CAST(sum(length(name)) AS BIGINT) AS name_chars FROM a
UNION ALL
SELECT 'passes', count(*), count(DISTINCT k), CAST(sum(event_id) AS BIGINT), count(*) - count(k), CAST(sum(length(k)) AS BIGINT)
FROM (SELECT event_id, 'user ' || json_extract_string(props, '$.k') AS k FROM events WHERE event_type = 'click')
""")
def q_export_flat_inputs(spark, sf):
    passes = q_flatten_events(spark, sf)
    names = F.col("player_name")
    awkward = F.element_at(F.array(F.concat(names, F.lit("\nx")), F.concat(F.lit(" "), names, F.lit(" ")), F.lit(""), F.lit(None),
                                   F.concat(names, F.lit('|"')), F.concat(F.lit("\\"), names), names), (F.col("player_id") % 7 + 1).cast("int"))
    written = J.export_flat_inputs(_flat_lineup(spark, sf).withColumn("player_name", awkward), passes, scratch_path(spark, "flat"))
    # the exports read back with an explicit schema, names in the order of the file
    ids = S.create_schema([["match_id", "BIGINT"], ["team_id", "BIGINT"], ["team_name", "STRING"], ["player_id", "BIGINT"],
                           ["player_name", "STRING"], ["country", "STRING"]], nullable=True)
    lineups = spark.read.options(**S.EXPORT_CSV_OPTIONS).schema(ids).csv(written["lineups"])
    back = spark.read.parquet(written["passes"])
    return (lineups.select(F.lit("lineups").alias("export"), F.col("player_name").alias("name"), F.col("player_id").alias("id"))
            .union(back.select(F.lit("passes"), "recipient_name", "event_id"))
            .groupBy("export").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("name").alias("n_names"),
                                   F.sum("id").alias("id_sum"), (F.count(F.lit(1)) - F.count("name")).alias("n_null"),
                                   F.sum(F.length("name")).cast("bigint").alias("name_chars")))


# ============================================================ metrics ======

def _event_log(spark, sf) -> DataFrame:
    """The events table written as an event log: one JSON record per event with epoch
    seconds, asset key and metadata entries (two numeric, one text)."""
    ev = table(spark, sf, "events")
    epoch = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("ts")) / F.lit(1e6)
    entries = F.array(
        F.struct(F.lit("value").alias("label"), F.col("value").cast("string").alias("value")),
        F.struct(F.lit("k").alias("label"), F.get_json_object("props", "$.k").alias("value")),
        F.struct(F.lit("note").alias("label"), F.concat(F.lit("user "), F.col("user_id")).alias("value")),
    )
    record = F.to_json(F.struct(epoch.alias("timestamp"), F.col("event_type").alias("asset_key"),
                                entries.alias("metadata_entries")))
    return ev.select("event_id", F.col("event_type").alias("asset_key"), record.alias("event"))


@register("metric_keys", """
SELECT DISTINCT event_type AS event_type FROM events
WHERE event_type IS NOT NULL AND event_type <> '' AND contains(event_type, 'i')
""")
def q_metric_keys(spark, sf):
    return R.distinct_keys(table(spark, sf, "events"), "event_type", contains="i")


@register("metric_events", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text, event_type AS asset_key, 'value' AS label, value
FROM events WHERE contains(event_type, 'i')
UNION ALL
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S'), event_type, 'k', CAST(json_extract_string(props, '$.k') AS DOUBLE)
FROM events WHERE contains(event_type, 'i')
""")
def q_metric_events(spark, sf):
    # the log is read back as a catalog table, as a job reads its event-log table
    view = f"event_logs_{uuid.uuid4().hex[:8]}"
    _event_log(spark, sf).createOrReplaceTempView(view)
    log = S.read_table(spark, view)
    keys = R.distinct_keys(log, "asset_key", contains="i")
    selected = M.select_keys(log, keys, "asset_key")
    return M.metric_entries(selected, "event", keep=["event_id"])


def _daily_series(spark, sf) -> DataFrame:
    entries = M.metric_entries(_event_log(spark, sf), "event", keep=["event_id"])
    daily = entries.where(F.col("label") == "value").withColumn("day", M.bucket("ts_text", "day"))
    return M.latest_per_bucket(daily, "day", "asset_key", "value", ["ts_text", "event_id"])


_DAILY_SQL = """
x AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS asset_key, value FROM events
      QUALIFY row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d'), event_type
                                 ORDER BY strftime(ts, '%Y-%m-%d %H:%M:%S') DESC, event_id DESC) = 1)"""

_METRIC_KEYS = ["click", "error", "purchase", "signup", "view"]


@register("metric_pivot", f"""
WITH {_DAILY_SQL},
w AS (SELECT day, {', '.join(f"max(value) FILTER (WHERE asset_key = '{k}') AS {k}" for k in _METRIC_KEYS)}
      FROM x GROUP BY day)
SELECT * FROM w WHERE {' AND '.join(f'{k} IS NOT NULL' for k in _METRIC_KEYS)}
""")
def q_metric_pivot(spark, sf):
    return M.pivot_keys(_daily_series(spark, sf), "day", "asset_key", "value", order=["day"])


@register("metric_pct_change", f"""
WITH {_DAILY_SQL},
y AS (SELECT *, lag(value) OVER (PARTITION BY asset_key ORDER BY day) AS prev FROM x)
SELECT day, asset_key, value, CASE WHEN prev = 0 THEN NULL ELSE value / prev - 1.0 END AS pct_change FROM y
""")
def q_metric_pct_change(spark, sf):
    return M.pct_change(_daily_series(spark, sf), "asset_key", "day", "value")
