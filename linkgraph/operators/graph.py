"""Property-graph operators (G1-G9): edges, weights, attribute sets, nodes.

Data model: an *edge event* table has endpoint columns suffixed ``1``/``2``
(``NodeID1``, ``NodeName1``, ``NodeID2`` ...) and shared columns unsuffixed.
A *node* table has ``NodeID``, ``Label`` and free attributes.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkgraph.functions import expressions as X
from linkgraph.operators.relational import task_parts, union_all_by_name
from linkgraph.session import cut_lineage

# --- fixed values: bulk-import header naming ------------------------------
START_ID_SUFFIX = ":START_ID"
END_ID_SUFFIX = ":END_ID"
ID_SUFFIX = ":ID"
LABEL_HEADER = ":LABEL"
EDGE_WEIGHT = "edge_weight"
ATT_SUFFIX = "_att"
# ---------------------------------------------------------------------------


class Graph(NamedTuple):
    edges: DataFrame
    nodes: DataFrame


def _listify(v) -> list[str]:
    if not v:
        return []
    return [v] if isinstance(v, str) else list(v)


# ---------------------------------------------------------------- G1 -------

_SPLITS = "__splits__"
_ROW, _COL = "__cell_row__", "__cell_col__"


#: Buckets of the first histogram of keys.
_BUCKETS = 8192


def hot_key_splits(df: DataFrame, key: str, target_parts: int | None = None, buckets: int = _BUCKETS) -> DataFrame:
    """The keys of ``_hot_keys``, without the number of rows."""
    return _hot_keys(df, key, target_parts, buckets)[0]


def _hot_keys(df: DataFrame, key: str, target_parts: int | None = None, buckets: int = _BUCKETS) -> tuple[DataFrame, int]:
    """Keys whose self-join work is more than one partition's share, with the number
    of parts to cut each into, ``(key, __splits__)``, and the number of rows that have a key.

    A key with ``k`` rows yields about ``k^2`` pairs, so hotness is measured in pair
    work, not rows: ``splits = ceil(k^2 * target_parts / W)`` with ``W = sum k^2`` over
    all keys, and a key is hot when ``splits >= 2``.

    Keys are not counted one by one.  One pass adds up rows by a hash bucket of the
    key, map-side, so that only ``buckets`` rows a task are shuffled.  A bucket has at
    least as many rows as any key in it: a key in a bucket of ``c`` rows cannot be hot
    unless ``c^2 * target_parts > W``, and the exact count runs over the keys of such
    buckets alone; none is missed, none is sampled.  ``W`` follows from the same
    histogram: two keys share a bucket with probability ``1 / buckets``, so the sum of
    ``c^2`` exceeds ``W`` by ``(N^2 - W) / buckets`` on average, and what is left has a
    standard error of ``W * sqrt(2 / buckets)`` (1.6 %), whatever the number of rows.
    Where so many rows fall into each bucket that most could hold a hot key, a finer
    histogram over their keys narrows them down before the exact count.  A bucket it leaves
    has more than ``sqrt(W / target_parts)`` rows, four times what a bucket of that histogram
    has on average, so that few come back; if none does, no key is hot and no row is read again.

    A hot key has more than ``W / target_parts`` of the work, so there are fewer than
    ``target_parts`` hot keys (up to the error of ``W``) whatever the data: the table
    has a proven size bound and may be broadcast.
    """
    spark = df.sparkSession
    parts = target_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = df.where(F.col(key).isNotNull()).select(key)

    def bucket(n: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(n)).alias("__bucket__")

    counts = [tuple(r) for r in keys.groupBy(bucket(buckets)).agg(F.count(F.lit(1))).collect()]  # `buckets` rows at most
    n = sum(c for _, c in counts)
    work = max((sum(c * c for _, c in counts) * buckets - n * n) / (buckets - 1), n)
    hot = [(b, c) for b, c in counts if c * c * parts > work]
    none = keys.select(key, F.lit(0).alias(_SPLITS)).where(F.lit(False))  # planned away: no further job
    if not hot:
        return none, n
    if len(hot) < len(counts):
        keys = keys.where(bucket(buckets).isin([b for b, _ in hot]))
    if sum(c for _, c in hot) > n // 8:
        finer = 1 << math.ceil(math.log2(4 * n / math.sqrt(work / parts)))
        if finer > buckets:
            candidates = (keys.groupBy(bucket(finer)).agg(F.count(F.lit(1)).cast("double").alias("__c__"))
                          .where(F.col("__c__") * F.col("__c__") * parts > work).select("__bucket__"))
            found = candidates.limit(buckets + 1).collect()
            if not found:
                return none, n
            if len(found) <= buckets:  # all of them: no shuffle of the keys
                candidates = F.broadcast(spark.createDataFrame(found, candidates.schema))
            keys = keys.withColumn("__bucket__", bucket(finer)).join(candidates, on="__bucket__", how="left_semi")
    k = F.col("__k__")
    return (keys.groupBy(key).agg(F.count(F.lit(1)).cast("double").alias("__k__"))
            .select(key, F.ceil(k * k * parts / F.lit(float(work))).cast("int").alias(_SPLITS)).where(F.col(_SPLITS) >= 2)), n


def edges_from_shared_key(df: DataFrame, col_edges: str = "EdgeID", col_nodeid: str = "NodeID",
                          node_att: Sequence[str] | None = None, distinct: bool = True,
                          split_hot_keys: bool = True, target_parts: int | None = None) -> DataFrame:
    """Undirected edges between every two nodes that share a value of ``col_edges``.

    Each unordered pair appears once per key, as ``NodeID1 > NodeID2`` (no
    self-pairs).  The left side keeps all of its columns (node attributes get
    suffix ``1``); the right side contributes only the node ID and ``node_att``
    (suffix ``2``).  ``distinct=False`` skips the de-duplication of the left
    side, for callers that aggregate duplicate-insensitively afterwards.

    Plan: each side is hash-partitioned once on the key (and the grid cell, when hot
    keys are split) and de-duplicated locally, so the join needs no further exchange;
    a join of two distinct inputs whose output carries every input column is already
    distinct, so no distinct over the (much larger) pair table is needed.

    Hot keys: the pairs of a key are the output itself (quadratic in the group
    size), so the pairs of a hot key are laid out as a square grid of cells instead
    of landing in one task.  A left row has a grid row (a hash of all its columns, so
    a node with many rows is spread too) and is copied to the cells of that row; a
    right row has a grid column and is copied along it; every (left, right) pair meets
    in exactly one cell.  The exchange has a fixed number of partitions, which
    adaptive execution does not coalesce: it goes by input bytes, the work is
    quadratic.  Without hot keys large inputs are dealt by rows (``task_parts``), for the
    same reason.  Nothing is capped or sampled.  Detection is the only eager step: one
    job over the key column if no key is hot, and the plan is then the plain
    partitioned self-join.
    """
    atts = _listify(node_att)
    parts = target_parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    valid = F.col(col_edges).isNotNull() & F.col(col_nodeid).isNotNull()
    base = df.where(valid)
    hot_rows, by_rows = [], None
    if split_hot_keys:
        # fewer than `parts` rows (proven bound) come back, and both join sides use the very same list
        detected, n_rows = _hot_keys(base, col_edges, parts)
        hot_rows, by_rows = detected.collect(), task_parts(df.sparkSession, n_rows)
    right_cols = [F.col(col_edges), F.col(col_nodeid).alias("NodeID2"), *[F.col(a).alias(f"{a}2") for a in atts]]
    if hot_rows:
        hot = df.sparkSession.createDataFrame(hot_rows, detected.schema)
        side = (F.ceil(F.sqrt(F.coalesce(F.col(_SPLITS), F.lit(1))))).cast("int")
        base = base.join(F.broadcast(hot), on=col_edges, how="left").withColumn(_SPLITS, side)
        along = F.explode(F.sequence(F.lit(0), F.col(_SPLITS) - 1))

        def own(cols):
            return F.pmod(F.xxhash64(*cols), F.col(_SPLITS)).cast("int")

        keys = [col_edges, _ROW, _COL]
        left = base.select(*df.columns, own([F.col(c) for c in df.columns]).alias(_ROW), along.alias(_COL))
        right = base.select(*right_cols, own([F.col(col_nodeid), *[F.col(a) for a in atts]]).alias(_COL), along.alias(_ROW))
        # equal rows of a hot key are combined as well: they would share a grid row
        left, right = (x.repartition(max(parts, by_rows or 0), *keys).dropDuplicates() for x in (left, right))
    else:
        # no hot key: the plain self-join, with exactly the partitioning that the distincts and the join need
        keys = [col_edges]
        dealt = [by_rows, *keys] if by_rows else keys
        left, right = df.where(valid).repartition(*dealt), base.select(*right_cols).repartition(*dealt).dropDuplicates()
        if distinct:
            left = left.dropDuplicates()
    pairs = (left.join(right, on=keys, how="inner")
                 .where(F.col(col_nodeid) > F.col("NodeID2"))
                 .drop(_ROW, _COL))
    renames = {col_nodeid: "NodeID1", **{a: f"{a}1" for a in atts}}
    return pairs.withColumnsRenamed(renames)


# ---------------------------------------------------------------- G2 -------

def filter_edges_by_threshold(df: DataFrame, distinct_col: str, col_gb: Sequence[str],
                              min_weight: int, max_weight: int) -> DataFrame:
    """Keep the detail rows of groups whose distinct count of ``distinct_col`` is in
    ``[min_weight, max_weight]``; result distinct, group columns first.

    Groups are counted with a two-phase distinct aggregate and matched back with a
    left-semi join (groups with a NULL key never match, see README).  The detail is
    made distinct first, on all its columns: a hot group is spread there, and the
    join is the last step, so that adaptive execution can split its partition.
    """
    keys = _listify(col_gb)
    groups = (df.groupBy(*keys)
                .agg(F.count_distinct(distinct_col).alias("__weight__"))
                .where(F.col("__weight__").between(min_weight, max_weight))
                .select(*keys))
    detail = df.select(*keys, *[c for c in df.columns if c not in keys]).dropDuplicates()
    return detail.join(groups, on=keys, how="left_semi").select(*detail.columns)


# ---------------------------------------------------------------- G3 / G4 --

def _injective_to_string(dt: T.DataType) -> bool:
    return isinstance(dt, (T.StringType, T.IntegralType, T.BooleanType, T.DateType))


def edge_aggregates(df: DataFrame, weight_col: str, att_cols: Sequence[str],
                    col_date: str | None = None) -> list[Column]:
    """Aggregate expressions for weighted edges: weight, ``<col>_att`` sets, date range.

    When the weight column is also rendered as a set and its text form is
    injective, the weight is the set size -- one partial aggregate instead of a
    separate distinct aggregation (saves a shuffle stage).
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    if weight_col in att_cols and _injective_to_string(types[weight_col]):
        # same collect_set as the weight column's set below (Spark evaluates it once)
        weight = F.size(F.collect_set(F.col(weight_col)))
    else:
        weight = F.count_distinct(weight_col)
    aggs = [weight.cast("bigint").alias(EDGE_WEIGHT)]
    aggs += [X.collect_set_string(c, _injective_to_string(types[c])).alias(f"{c}{ATT_SUFFIX}")
             for c in att_cols]
    if col_date:
        if isinstance(types[col_date], (T.DateType, T.TimestampNTZType, T.StringType)):
            # ISO text sorts like the value: take min/max on the compact value, render after
            d = F.col(col_date)
            aggs += [F.min(d).cast("string").alias(f"{col_date}_min"),
                     F.max(d).cast("string").alias(f"{col_date}_max")]
        else:
            d = F.col(col_date).cast("string")
            aggs += [F.min(d).alias(f"{col_date}_min"), F.max(d).alias(f"{col_date}_max")]
    return aggs


def endpoint_nodes(df: DataFrame, node_attributes: Mapping[str, Sequence[str] | str | None]) -> DataFrame:
    """Node table from endpoint columns: for each ``{id_col: [attrs]}`` select the ID
    and attributes, strip the last character of each name (``NodeID1`` -> ``NodeID``),
    union positionally and de-duplicate.  One pass: every row gives one row per side."""
    names = [c[:-1] for c in [next(iter(node_attributes)), *_listify(next(iter(node_attributes.values())))]]
    sides = [F.struct(*[F.col(c).alias(n) for c, n in zip([id_col, *_listify(atts)], names, strict=True)])
             for id_col, atts in node_attributes.items()]
    return df.select(F.inline(F.array(*sides))).dropDuplicates()


#: Detail rows of one edge from which its sets are rendered in chunks.
SET_ROWS = 100_000


def _same_pair(a: DataFrame, b: DataFrame, ids: Sequence[str], null_ids: bool) -> DataFrame:
    """Semi-join on a pair of endpoint columns; with ``null_ids`` NULL equals NULL, as in a group."""
    if not null_ids:  # an equality join shares the partitioning of the aggregates around it
        return a.join(b.select(*ids), on=list(ids), how="left_semi")
    b = b.select(*[F.col(c).alias(f"__{c}__") for c in ids])
    same = [F.col(c).eqNullSafe(F.col(f"__{c}__")) for c in ids]
    return a.join(b, on=same[0] & same[1], how="left_semi")


def chunked_sets(df: DataFrame, keys: Sequence[str], cols: Sequence[str], n_rows: int, chunk_rows: int = SET_ROWS) -> DataFrame:
    """``(keys, <col>_att ...)``: the same text sets as ``collect_set_string``, for sets of any size.

    No task holds the values of a set.  Distinct (keys, column, value) rows are sorted
    by range into slices of about ``chunk_rows`` rows, each slice renders its part of
    a set as one text, and the parts are put together in slice order: what a task
    holds is one slice, or one finished text.  ``n_rows`` is the number of detail rows,
    which sets the number of slices.
    """
    keys = list(keys)
    texts = F.inline(F.array(*[F.struct(F.lit(i).alias("__set__"), F.col(c).cast("string").alias("__text__")) for i, c in enumerate(cols)]))
    values = df.select(*keys, texts).where(F.col("__text__").isNotNull()).distinct()
    sort = [*keys, "__set__", "__text__"]
    slices = max(1, math.ceil(n_rows * len(cols) / chunk_rows))
    parts = (values.repartitionByRange(slices, *sort).withColumn("__slice__", F.spark_partition_id())
             .groupBy(*keys, "__set__", "__slice__")
             .agg(F.array_join(F.array_sort(F.collect_list("__text__")), X.SET_SEPARATOR).alias("__part__")))

    def whole(i: int) -> Column:
        found = F.array_sort(F.collect_list(F.when(F.col("__set__") == i, F.struct("__slice__", "__part__"))))
        return F.concat(F.lit("["), F.array_join(F.transform(found, lambda x: x["__part__"]), X.SET_SEPARATOR), F.lit("]"))

    return parts.groupBy(*keys).agg(*[whole(i).alias(f"{c}{ATT_SUFFIX}") for i, c in enumerate(cols)])


def _left_on_pair(a: DataFrame, b: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Left join on a pair of endpoint columns, NULL equal to NULL: ``b`` may lack a pair."""
    b = b.withColumnsRenamed({c: f"__{c}__" for c in ids})
    same = [F.col(c).eqNullSafe(F.col(f"__{c}__")) for c in ids]
    return a.join(b, on=same[0] & same[1], how="left").drop(*[f"__{c}__" for c in ids])


def _edges_with_sets(df: DataFrame, ids: list[str], weights: DataFrame, weight_col: str, att_cols: list[str],
                     col_date: str | None, large_sets: bool, null_ids: bool) -> DataFrame:
    """Second phase: sets for the pairs of ``weights`` alone; with ``large_sets`` those of many rows are rendered in chunks."""
    aggs = edge_aggregates(df, weight_col, att_cols, col_date)
    names = [*ids, EDGE_WEIGHT, *[f"{c}{ATT_SUFFIX}" for c in att_cols], *([f"{col_date}_min", f"{col_date}_max"] if col_date else [])]
    if large_sets:
        wide = weights.where(F.col("__rows__") > SET_ROWS)
        n_rows = wide.agg(F.sum("__rows__")).first()[0]
        if n_rows:
            rest = _same_pair(df, weights.where(F.col("__rows__") <= SET_ROWS), ids, null_ids).groupBy(*ids).agg(*aggs)
            wide_rows = _same_pair(df, wide, ids, null_ids)
            text = [F.coalesce(f"{c}{ATT_SUFFIX}", F.lit("[]")).alias(f"{c}{ATT_SUFFIX}") for c in att_cols]
            out = _left_on_pair(wide, chunked_sets(wide_rows, ids, att_cols, n_rows), ids)
            if col_date:
                out = _left_on_pair(out, wide_rows.groupBy(*ids).agg(*aggs[1 + len(att_cols):]), ids)
            return rest.select(*names).unionByName(out.select(*ids, EDGE_WEIGHT, *text, *names[3 + len(att_cols):]))
    return _same_pair(df, weights, ids, null_ids).groupBy(*ids).agg(*aggs).select(*names)


def edges_agg(df: DataFrame, weight_col: str, cols_gb: Sequence[str] = ("NodeID1", "NodeID2"),
              col_date: str | None = None, min_edges: int = 1,
              node_att: Sequence[str] | None = None,
              att_cols: Sequence[str] | None = None,
              node_lookup: Mapping[str, DataFrame] | None = None, cut: bool = False,
              late_sets: bool = False, large_sets: bool = False, null_ids: bool = True) -> Graph:
    """Weighted edges plus the node table of their endpoints.

    Edges: ``groupBy(cols_gb)`` with ``edge_weight`` = distinct count of
    ``weight_col``, one ``<col>_att`` text set per attribute column (default:
    every column that is neither a key nor a node attribute, in input order),
    ``<date>_min/_max`` as text, and ``edge_weight >= min_edges``.

    Nodes: for each endpoint side, the distinct (ID, attributes) rows whose ID
    is that side's endpoint of a kept edge (semi-join on that side only, so IDs
    shared by two labels do not leak across), unioned and de-duplicated.

    ``node_lookup`` ({endpoint id column: table with ``NodeID`` and the side's
    attributes}) is for sides whose attributes come from a dimension table keyed
    by the node ID: the side's nodes are then its kept endpoint IDs left-joined to
    that table -- the same rows, without reading the event table again.

    ``late_sets`` aggregates in two phases: weights first, by a hash aggregate of
    numbers, then a semi-join, and sets only for the pairs that stay.  It reads ``df``
    twice, so it pays where ``df`` is cheap or stored and ``min_edges`` drops many pairs;
    on large inputs Spark adds a Bloom filter
    of the kept pairs to the scan.  Sets are built by an object aggregate, which
    sorts once a task has seen ``spark.sql.objectHashAggregate.sortBased.fallbackThreshold``
    pairs (128); raise it where executors have room for more.

    ``large_sets`` also finds the pairs of more than ``SET_ROWS`` rows (one small job)
    and renders their sets in chunks, so that no task holds the values of one set.
    ``null_ids=False`` says that no endpoint is NULL, which saves both kinds of late sets
    two shuffles; otherwise pairs with a NULL endpoint are kept like any other.

    ``cut=True`` writes the edges to the checkpoint folder first and takes the kept
    endpoints from there, so that callers who need both edges and nodes compute ``df``
    (say, a quadratic pair table) once.
    """
    id1, id2 = _listify(cols_gb)
    atts = _listify(node_att)
    node_x = [f"{a}1" for a in atts]
    node_y = [f"{a}2" for a in atts]
    if att_cols is None:
        excluded = {id1, id2, *node_x, *node_y}
        att_cols = [c for c in df.columns if c not in excluded]
    att_cols = list(att_cols)
    # kept endpoint pairs from a light hash aggregate (same weight, no sets)
    kept = (df.groupBy(id1, id2).agg(F.count_distinct(weight_col).alias("__w__"))
              .where(F.col("__w__") >= F.lit(min_edges)))
    if (late_sets or large_sets) and att_cols:
        # numbers alone: a least or greatest text would make it a sort aggregate
        first = edge_aggregates(df, weight_col, [])
        weights = (df.groupBy(id1, id2).agg(*first, F.count(F.lit(1)).alias("__rows__"))
                     .where(F.col(EDGE_WEIGHT) >= F.lit(min_edges)))
        if cut or large_sets:
            weights = cut_lineage(weights, "weights")
        edges, kept = _edges_with_sets(df, [id1, id2], weights, weight_col, att_cols, col_date, large_sets, null_ids), weights
    else:
        edges = (df.groupBy(id1, id2)
                   .agg(*edge_aggregates(df, weight_col, att_cols, col_date))
                   .where(F.col(EDGE_WEIGHT) >= F.lit(min_edges)))
    if cut:
        edges = kept = cut_lineage(edges, "edges")

    def side(id_col: str, cols: list[str]) -> DataFrame:
        # distinct first: a hub node appears in many kept pairs, and the join
        # side must not carry it as a hot key
        kept_ids = kept.select(F.col(id_col).alias(id_col[:-1])).distinct()
        if node_lookup and id_col in node_lookup:
            lookup = node_lookup[id_col]
            out = kept_ids.join(lookup, on=id_col[:-1], how="left")
            return out.select(*[c[:-1] for c in [id_col, *cols]]).dropDuplicates()
        nodes = df.select(*[F.col(c).alias(c[:-1]) for c in [id_col, *cols]]).dropDuplicates()
        return nodes.join(kept_ids, on=id_col[:-1], how="left_semi")

    nodes = side(id1, node_x).union(side(id2, node_y)).dropDuplicates()
    return Graph(edges, nodes)


# ---------------------------------------------------------------- G5-G8 ----

def merge_nodes(dfs: Sequence[DataFrame]) -> DataFrame:
    """All node tables in one: union by name, missing attributes NULL, columns sorted."""
    return union_all_by_name(list(dfs))


def label_profile(nodes: DataFrame, label_col: str = "Label",
                  labels: Sequence[str] | None = None) -> dict[str, list[str]]:
    """For every label (or the given ones), the columns that hold at least one non-NULL value.

    One ``groupBy(label)`` pass for all labels; the result (one row per label, which is
    one output folder each) comes to the driver because it decides output schemas.
    Nodes without a label have no export and no profile.
    """
    other = [c for c in nodes.columns if c != label_col]
    if labels is not None:
        nodes = nodes.where(F.col(label_col).isin(list(labels)))
    rows = (nodes.where(F.col(label_col).isNotNull()).groupBy(label_col)
                 .agg(*[F.count(c).alias(f"__n{i}__") for i, c in enumerate(other)]).collect())
    return {r[label_col]: [c for i, c in enumerate(other) if r[f"__n{i}__"] > 0] for r in rows}


def nodes_for_label(nodes: DataFrame, label: str, label_col: str = "Label", id_col: str = "NodeID",
                    keep_cols: Sequence[str] | None = None) -> DataFrame:
    """Export table of one label: filter, distinct, drop all-NULL columns,
    ``NodeID`` -> ``<LABEL>:ID`` and ``Label`` -> ``:LABEL``.

    ``keep_cols`` (from ``label_profile``) avoids a per-label profiling pass.
    """
    one = nodes.where(F.col(label_col) == F.lit(label))
    if keep_cols is None:
        keep_cols = label_profile(one, label_col).get(label, [c for c in nodes.columns if c != label_col])
    cols = [c for c in nodes.columns if c == label_col or c in set(keep_cols) or c == id_col]
    return (one.select(*cols).dropDuplicates()
               .withColumnsRenamed({id_col: f"{label.upper()}{ID_SUFFIX}", label_col: LABEL_HEADER}))


def edge_header_names(df: DataFrame, id1: str = "NodeID1", id2: str = "NodeID2") -> DataFrame:
    """Bulk-import names for the endpoint columns."""
    return df.withColumnsRenamed({id1: f"{id1}{START_ID_SUFFIX}", id2: f"{id2}{END_ID_SUFFIX}"})


def unique_nodes(nodes: DataFrame, key: Sequence[str] = ("Label", "NodeID"),
                 order_by: Sequence[str] | None = None) -> DataFrame:
    """One node per key: the row with the smallest ``order_by`` tuple, ties broken by
    the remaining columns.  Cut to one row per key before the shuffle, safe for hot keys."""
    keys = _listify(key)
    others = [c for c in nodes.columns if c not in keys]
    if not others:
        return nodes.dropDuplicates()
    return X.survivors(nodes, keys, _listify(order_by))


# ---------------------------------------------------------------- G9 -------

def _endpoint_ids(nodes: DataFrame, label: str | None, label_col: str, id_col: str) -> DataFrame:
    n = nodes if label is None else nodes.where(F.col(label_col) == F.lit(label))
    return n.select(F.col(id_col)).where(F.col(id_col).isNotNull()).distinct()


def edges_with_endpoints(edges: DataFrame, nodes: DataFrame, src_label: str | None = None,
                         dst_label: str | None = None, id1: str = "NodeID1", id2: str = "NodeID2",
                         label_col: str = "Label", id_col: str = "NodeID") -> DataFrame:
    """Edges whose both endpoints exist as nodes (of the given labels): two semi-joins."""
    src = _endpoint_ids(nodes, src_label, label_col, id_col).withColumnRenamed(id_col, id1)
    dst = _endpoint_ids(nodes, dst_label, label_col, id_col).withColumnRenamed(id_col, id2)
    return edges.join(src, on=id1, how="left_semi").join(dst, on=id2, how="left_semi").select(*edges.columns)


def dangling_edges(edges: DataFrame, nodes: DataFrame, src_label: str | None = None,
                   dst_label: str | None = None, id1: str = "NodeID1", id2: str = "NodeID2",
                   label_col: str = "Label", id_col: str = "NodeID") -> DataFrame:
    """Edges missing at least one endpoint, with flags telling which."""
    src = (_endpoint_ids(nodes, src_label, label_col, id_col)
           .select(F.col(id_col).alias(id1), F.lit(True).alias("__src__")))
    dst = (_endpoint_ids(nodes, dst_label, label_col, id_col)
           .select(F.col(id_col).alias(id2), F.lit(True).alias("__dst__")))
    flagged = edges.join(src, on=id1, how="left").join(dst, on=id2, how="left")
    return (flagged.where(F.col("__src__").isNull() | F.col("__dst__").isNull())
                   .select(*edges.columns,
                           F.col("__src__").isNull().alias("missing_start"),
                           F.col("__dst__").isNull().alias("missing_end")))
