"""Sharding by Karmarkar-Karp differencing: groups of equal texts into shards of nearly equal bytes.

Equal texts form a group that stays in one shard.  Groups smaller than a
``BUNDLES``-th of all bytes are dealt by a hash to that many bundles, larger ones
(fewer than ``BUNDLES``) stand alone; bundle and group sizes are summed in Spark.
The items, at most twice ``BUNDLES`` whatever the input, start as partial
partitions with one filled part each.  The two with the largest spread are combined
again and again, the largest part of one with the smallest of the other, until one
partition is left: its parts are the shards.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkgraph.llm.common import stash

SHARDS = 24
#: Bundles of small groups; also the bound of the number of large groups.
BUNDLES = 8192
#: Bytes that a row takes beside its text.
ROW_BYTES = 8
#: Rows that are numbered together, on average.
SLICE_ROWS = 4096
LAW = "bytes"


def difference(sizes: Sequence[int], shards: int) -> list[int]:
    """Part of every item, by Karmarkar-Karp differencing; parts are numbered from the largest sum down.

    A partial partition is its part sums in descending order less the smallest
    one, each with one of the part's items; a union-find joins the items of parts
    that are put together.  Ties go to the earlier partition.
    """
    if not sizes:
        return []
    parent = list(range(len(sizes)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    empty = [(0, -1)] * (shards - 1)
    heap = [(-s, i, [(s, i), *empty]) for i, s in enumerate(sizes)]
    if shards == 1:
        return [0] * len(sizes)
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        parts = []
        for (s, x), (t, y) in zip(a, reversed(b), strict=True):
            if x >= 0 and y >= 0:
                parent[find(y)] = find(x)
            parts.append((s + t, x if x >= 0 else y))
        parts.sort(key=lambda p: (-p[0], p[1]))
        least = parts[-1][0]
        heapq.heappush(heap, (least - parts[0][0], serial, [(s - least, x) for s, x in parts]))
        serial += 1
    part = {find(x): k for k, (_, x) in enumerate(heap[0][2]) if x >= 0}
    return [part[find(i)] for i in range(len(sizes))]


def _keys(text: Column) -> list[Column]:
    """What tells groups apart.  Two texts that share all three would only share a shard."""
    body = F.coalesce(text.cast("string"), F.lit(""))
    return [F.xxhash64(body).alias("_h"), F.crc32(body).cast("long").alias("_crc"),
            (F.octet_length(body) + ROW_BYTES).cast("long").alias("_size")]


def plan(docs: DataFrame, shards: int = SHARDS, text: str = "text", bundles: int = BUNDLES) -> DataFrame:
    """(_h, _crc, _size, _bundle, shard): the shard of every bundle (by its number) and of every large group (by its keys; bundle -1)."""
    keys = ["_h", "_crc", "_size"]
    groups = stash(docs.select(*_keys(docs[f"`{text}`"])).groupBy(*keys).agg(F.count("*").alias("copies"))
                   .select(*keys, (F.col("copies") * F.col("_size")).alias("bytes")), "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    alone = F.col("bytes") * bundles > F.lit(total)
    # no nulls: they would reach pandas as floating point numbers
    items = (groups.select(*[F.when(alone, F.col(c)).otherwise(F.lit(0)).alias(c) for c in keys],
                           F.when(alone, F.lit(-1)).otherwise(F.pmod("_h", F.lit(bundles))).cast("int").alias("_bundle"), "bytes")
             .groupBy(*keys, "_bundle").agg(F.sum("bytes").alias("bytes")))

    def deal(items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["bytes", "_bundle", "_h", "_crc", "_size"], ascending=False, ignore_index=True)
        items["shard"] = difference([int(b) for b in items["bytes"]], shards)
        return items.drop(columns=["bytes", "one"])

    # at most 2 * bundles rows in all, at every size of the input
    out = items.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(
        deal, "_h long, _crc long, _size long, _bundle int, shard int")
    return stash(out, "shard-plan")


def _assigned(rows: DataFrame, planned: DataFrame, bundles: int) -> DataFrame:
    """``rows`` (with the keys) and the shard that the plan gives; both lookups have a proven bound of ``bundles`` rows."""
    large = planned.where("_bundle < 0").select(F.col("_h").alias("h2"), F.col("_crc").alias("c2"), F.col("_size").alias("s2"),
                                                    F.col("shard").alias("own"))
    small = planned.where("_bundle >= 0").select(F.col("_bundle").alias("b2"), F.col("shard").alias("shared"))
    return (rows.join(F.broadcast(large), (F.col("_h") == F.col("h2")) & (F.col("_crc") == F.col("c2")) & (F.col("_size") == F.col("s2")), "left")
            .join(F.broadcast(small), F.pmod("_h", F.lit(bundles)).cast("int") == F.col("b2"), "left")
            .withColumn("_shard", F.coalesce("own", "shared")).drop("h2", "c2", "s2", "own", "b2", "shared"))


def sharded(docs: DataFrame, shards: int = SHARDS, text: str = "text", into: str = "shard", bundles: int = BUNDLES) -> DataFrame:
    """Every row of ``docs`` with all its columns and its shard in ``into`` (a column of that name gives way).

    * null and empty texts are one group of rows of 8 bytes; repeated rows share a shard.
    * an empty table gives an empty result.  With fewer groups than shards some shards stay empty.
    * a group larger than a shard's share fills a shard by itself; groups are never cut.
    """
    planned = plan(docs, shards, text, bundles)
    kept = [docs[f"`{c}`"] for c in docs.columns if c != into]
    rows = docs.select(F.struct(*kept).alias("row"), *_keys(docs[f"`{text}`"]))
    return _assigned(rows, planned, bundles).select("row.*", F.col("_shard").alias(into))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, text: str = "text", file_rows: int = 1_000_000) -> None:
    """Write the rows as Parquet, one folder ``shard=k`` each, in files of bounded length.

    Every task writes its own rows of every shard, so a shard is never one task.
    """
    sharded(docs, shards, text).write.option("maxRecordsPerFile", file_rows).partitionBy("shard").parquet(path)


def slots(docs: DataFrame, shards: int = SHARDS, text: str = "text", key: str = "doc_id", bundles: int = BUNDLES,
          slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row; slots of a shard are numbered from 0 without gaps.

    Rows are numbered inside slices of a shard, cut by a hash, from the slice's
    first number on.  Rows equal in id and text are counted first and take
    consecutive slots, so neither copies nor repeated rows meet in one task; null
    ids come first in a slice.  ``grown_shard`` is null: under this law shards may
    all change when one is added.
    """
    planned = plan(docs, shards, text, bundles)
    rows = docs.select(docs[f"`{key}`"].cast("long").alias("doc_id"), *_keys(docs[f"`{text}`"]))
    # the shard follows from the keys, so equal rows are counted with it
    rows = _assigned(rows, planned, bundles).groupBy("_shard", "doc_id", "_h", "_crc", "_size").agg(F.count("*").alias("n"))
    rows = stash(rows, "shard-rows")
    most = rows.count() // slice_rows // shards + 1
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("doc_id", "_h", "_crc"), F.lit(most)))
    before = Window.partitionBy("_shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    first = (rows.groupBy("_shard", "slice").agg(F.sum("n").alias("in_slice"))
             .select(F.col("_shard").alias("s2"), F.col("slice").alias("p2"), F.coalesce(F.sum("in_slice").over(before), F.lit(0)).alias("first")))
    inside = Window.partitionBy("_shard", "slice").orderBy("doc_id", "_h", "_crc", "_size").rowsBetween(Window.unboundedPreceding, -1)
    rows = (rows.withColumn("at", F.coalesce(F.sum("n").over(inside), F.lit(0)))
            .join(first, (F.col("_shard") == F.col("s2")) & (F.col("slice") == F.col("p2"))))
    # repeated rows in two steps, so that no array of numbers grows beyond a thousand entries for each million
    step = 1 << 10
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / step))))
    last = F.least(F.lit(step).cast("long"), F.col("n") - F.col("block") * step) - 1
    rows = rows.withColumn("one", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return rows.select("doc_id", F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.lit(LAW).alias("law"),
                       F.col("_shard").alias("shard"), (F.col("first") + F.col("at") + F.col("block") * step + F.col("one")).alias("slot"),
                       F.lit(None).cast("int").alias("grown_shard"))
