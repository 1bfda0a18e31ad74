"""Mixing sources to target weights with hash-threshold histograms (DataFrame functions only).

Every document gets a 36-bit hash.  A source whose target is ``f`` whole copies
plus a remainder gives every document ``f`` times and once more to the documents
whose hash is below the source's threshold.  The threshold comes from a histogram
of sizes by (source, top 12 bits); only the bucket in which the remainder ends is
refined by the next 12 bits, twice.  Nothing is sorted but the 4,096 bucket
sums of a source.  Budgets are nested: a smaller target keeps a subset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkgraph.llm.common import WORD_RE, stash

BITS, LEVELS = 12, 3
#: Documents that fill the gap before a long one have at most this part of its room.
FILL = 2
MAX_REPEAT = 3.0


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def unit_hash(*cols: Column) -> Column:
    """36-bit hash of a row."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 64 - BITS * LEVELS)


def weighted_targets(sources: DataFrame, weights: Sequence[float], limit: float = MAX_REPEAT) -> DataFrame:
    """(source, source_size) -> the same with ``target``: shares by weight, at most ``limit`` times a source's size.

    ``weights`` repeat over the sources in code point order, null last.  The
    total of all sizes is shared by weight; a target stops at ``limit`` times its
    source's size and the excess is shared again among the others.  The fixed
    point is found directly: in order of ``limit * size / weight``, sources stop
    until that ratio first exceeds the share per weight left to the others; the
    others all get that share.  The windows run over the list of sources alone.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    w = F.array(*[F.lit(float(x)) for x in weights])
    s = sources.withColumn("weight", F.element_at(
        w, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")))
    order = ["ratio", F.col("source").isNull(), F.col("source").cast("binary")]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    s = (s.withColumn("cap", F.lit(float(limit)) * F.col("source_size"))
         .withColumn("ratio", F.col("cap") / F.col("weight"))
         .withColumn("total", F.sum("source_size").over(everything).cast("double"))
         .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
         .withColumn("level", (F.col("total") - F.col("capped")) / F.col("open"))
         .withColumn("stops", ~F.max(F.col("ratio") > F.col("level")).over(upto))
         .withColumn("final", F.min(F.when(~F.col("stops"), F.struct("ratio", "capped", "level")))
                     .over(everything)["level"]))
    target = F.when(F.col("stops"), F.col("cap")).otherwise(F.col("weight") * F.col("final"))
    return s.select("source", "source_size", target.alias("target"))


def thresholds(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source the largest hash threshold whose documents (those below it) do not exceed the goal.

    ``sized``: (source, size, h); ``goals``: (source, goal).  Returns (source,
    threshold, rest): ``rest`` is what is missing to the goal.  A source without
    documents in ``sized`` gets no row.
    """
    state = goals.select(F.col("source").alias("s2"), F.col("goal").alias("left"), F.lit(None).cast("long").alias("edge"))
    for level in range(1, LEVELS + 1):
        shift = BITS * (LEVELS - level)
        at = F.col("source").eqNullSafe(F.col("s2"))
        rows = sized
        if level > 1:  # only the documents of the boundary bucket
            rows = rows.join(state, at & (F.shiftrightunsigned("h", shift + BITS) == F.col("edge")), "left_semi")
        sums = rows.groupBy("source", F.shiftrightunsigned("h", shift).alias("bucket")).agg(F.sum("size").alias("n"))
        run = Window.partitionBy("source").orderBy("bucket")
        begin = F.col("upto") - F.col("n")
        # the boundary bucket is the last one that begins within the budget
        state = stash(sums.withColumn("upto", F.sum("n").over(run)).join(state.select("s2", "left", "edge"), at).where(begin <= F.col("left"))
                      .groupBy("source").agg(F.max(F.struct("bucket", (F.col("left") - begin).alias("left"), "n")).alias("m"))
                      .select(F.col("source").alias("s2"), "m.left", F.col("m.bucket").alias("edge"), "m.n"),
                      "mix-level")
    whole = F.col("n") <= F.col("left")  # the last bucket is a single hash value
    return state.select(F.col("s2").alias("source"), (F.col("edge") + F.when(whole, 1).otherwise(0)).alias("threshold"),
                        (F.col("left") - F.when(whole, F.col("n")).otherwise(0)).alias("rest"))


def _sized_cols(docs: DataFrame, text: str, source: str, key: str) -> list[Column]:
    t, s, k = docs[f"`{text}`"], docs[f"`{source}`"], docs[f"`{key}`"]
    return [k.alias("k"), s.alias("source"), word_count(t).alias("size"), unit_hash(F.lit("mix"), k, t).alias("h")]


def _sized(docs: DataFrame, text: str, source: str, key: str) -> DataFrame:
    return docs.select(*_sized_cols(docs, text, source, key))


def mix_plan(sized: DataFrame, weights: Sequence[float], limit: float = MAX_REPEAT) -> DataFrame:
    """One row per source: (s2, source_size, target, full, below, rest, fill), stored in the checkpoint folder.

    A document is taken ``full`` times, once more if its hash is under ``below``,
    or if it is small against ``rest`` and its hash lies between ``below`` and ``fill``.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stash(weighted_targets(totals, weights, limit)
                    .withColumn("full", F.when(F.col("source_size") > 0,
                                               F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
                    .withColumn("goal", F.col("target") - F.col("full") * F.col("source_size")), "mix-targets")
    # a source at its limit or without words has no remainder to cut
    cut = thresholds(sized.select("source", "size", "h"),
                     targets.where((F.col("source_size") > 0) & (F.col("goal") > 0)).select("source", "goal"))
    # what is missing because the next document is too long comes from documents a good deal smaller than it
    small = (sized.join(cut.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2")))
             .where((F.col("h") > F.col("threshold")) & (F.col("size") * FILL <= F.col("rest"))))
    fill = thresholds(small.select("source", "size", "h"), cut.select("source", F.col("rest").alias("goal")))
    return stash(targets.alias("t").join(cut.alias("c"), F.col("t.source").eqNullSafe(F.col("c.source")), "left")
                 .join(fill.alias("f"), F.col("t.source").eqNullSafe(F.col("f.source")), "left")
                 .select(F.col("t.source").alias("s2"), "source_size", "target", "full",
                         F.coalesce("c.threshold", F.lit(0)).alias("below"), F.coalesce("c.rest", F.lit(0)).alias("rest"),
                         F.coalesce("f.threshold", F.lit(0)).alias("fill")), "mix-plan")


def _copies() -> Column:
    more = (F.col("h") < F.col("below")) | ((F.col("h") > F.col("below")) & (F.col("h") < F.col("fill"))
                                            & (F.col("size") * FILL <= F.col("rest")))
    return (F.col("full") + F.when(more, 1).otherwise(0)).cast("long")


def mix(docs: DataFrame, weights: Sequence[float], limit: float = MAX_REPEAT, text: str = "text",
        source: str = "source", key: str = "doc_id") -> DataFrame:
    """How often each document enters a mix whose sources weigh ``weights``.

    Returns (key, size, source_size, target, copies, taken), one row per input
    row.  ``size`` is the number of words, ``taken = size * copies``.

    * null text: size 0; null source: a source of its own, last in order.
    * rows equal in key and text share a hash, so they enter or stay out together.
    * a source of size 0 has target 0 and gives nothing.  An empty table gives an
      empty result.  Other columns are ignored, whatever their names.
    """
    sized = stash(_sized(docs, text, source, key), "mix-sizes")
    plan = mix_plan(sized, weights, limit)
    return (sized.join(plan, F.col("source").eqNullSafe(F.col("s2"))).withColumn("copies", _copies())
            .select(F.col("k").alias(key), "size", "source_size", "target", "copies",
                    (F.col("size") * F.col("copies")).alias("taken")))


def mixed(docs: DataFrame, weights: Sequence[float], limit: float = MAX_REPEAT, text: str = "text",
          source: str = "source", key: str = "doc_id") -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, each as often as ``mix`` takes it.

    The stored plan has one row per source, so Spark broadcasts it where its
    file size allows and the texts are not shuffled.
    """
    sized = stash(_sized(docs, text, source, key), "mix-sizes")
    plan = mix_plan(sized, weights, limit)
    row = docs.select(F.struct("*").alias("row"), *_sized_cols(docs, text, source, key))
    taken = (row.join(plan, F.col("source").eqNullSafe(F.col("s2"))).withColumn("copies", _copies())
             .where("copies > 0"))
    return (taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
            .select("row.*"))
