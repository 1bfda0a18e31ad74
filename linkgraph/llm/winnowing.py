"""Document fingerprints by winnowing (DataFrame functions only).

A text is lower-cased (A-Z) and cut into words; in scripts written without spaces
every character is one.  Every run of ``K`` words has a 64-bit hash, rolled from
hashes of the words; of every ``W`` consecutive hashes the smallest is chosen, the
rightmost one among equals.  Two texts that share ``W + K - 1`` words in a row
therefore share a chosen hash, and the chosen positions say where.  Other unbroken
runs longer than 32 characters count as pieces of 32 from their start; a match
inside such a run is found only where both texts cut it alike.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkgraph.llm.common import let, lower_ascii, stash, text_key
from linkgraph.llm.spans import UNSPACED

#: Words of a gram and grams of a window: any match of 8 words is found.
K, W = 5, 4
_UNSPACED = "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in UNSPACED)
PIECE_RE = rf"[{_UNSPACED}]|[^\x20\x09-\x0D{_UNSPACED}]{{1,32}}"


def _rotate(x: Column, bits: int) -> Column:
    return F.shiftleft(x, bits).bitwiseOR(F.shiftrightunsigned(x, 64 - bits))


def grams(words: Column, k: int = K) -> Column:
    """Hashes of all runs of ``k`` (below 64) words; fewer words: one hash of all; none: empty.

    A cyclic polynomial: every word is hashed once, and a run's hash is the exclusive
    or of its words' hashes, each rotated by the number of words behind it.  All runs
    of ``m`` words roll on to those of up to ``2 m`` by one rotation and one exclusive
    or each, so nothing is hashed again.
    """
    def runs(h: Column, m: int) -> Column:
        # past the last whole run there are nulls
        if m == 1:
            return h
        if m % 2:
            return F.transform(runs(h, m - 1), lambda v, i: _rotate(v, 1).bitwiseXOR(F.get(h, i + F.lit(m - 1))))
        return let(runs(h, m // 2), lambda a: F.transform(
            a, lambda v, i: _rotate(v, m // 2).bitwiseXOR(F.get(a, i + F.lit(m // 2)))))

    def of(h: Column) -> Column:
        n = F.size(h)
        whole = F.aggregate(h, F.lit(0).cast("bigint"), lambda a, x: _rotate(a, 1).bitwiseXOR(x))
        return (F.when(n == 0, F.array().cast("array<bigint>")).when(n < k, F.array(whole))
                .otherwise(F.slice(runs(h, k), F.lit(1), n - (k - 1))))
    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def chosen(hashes: Column, w: int = W) -> Column:
    """Winnowing: (hash, position) of the minimum of every window of ``w`` hashes, rightmost among equals.

    Position ``p`` is chosen iff some window holds only hashes >= its own to the
    left and > its own to the right, that is, iff the run of such neighbours
    around it is as long as a window.  Fewer than ``w`` hashes form one window.
    """
    def of(h: Column) -> Column:
        def pick(v: Column, i: Column) -> Column:
            def run(step: int, test) -> Column:
                # number of neighbours in one direction that pass, at most w - 1
                return reduce(lambda inner, j: F.when(test(F.get(h, i + F.lit(step * j))), inner).otherwise(F.lit(j - 1)),
                              range(w - 1, 0, -1), F.lit(w - 1))
            return run(-1, lambda o: o >= v) + run(1, lambda o: o > v) + 1 >= F.least(F.lit(w), F.size(h))
        return F.filter(F.transform(h, lambda v, i: F.when(pick(v, i), F.struct(v.alias("hash"), i.alias("pos")))),
                        lambda x: x.isNotNull())
    return let(hashes, of)


def fingerprint(text: Column, k: int = K, w: int = W) -> Column:
    """array<struct<hash, pos>> of a text; null counts as empty, a text without words has an empty fingerprint."""
    words = F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(PIECE_RE), F.lit(0))
    return chosen(grams(words, k), w)


def hashes(prints: Column) -> Column:
    """The set of chosen hashes, by their low 32 bits (two grams of a pair of texts agree there by chance once in 2^32)."""
    return F.array_distinct(F.transform(prints["hash"], lambda h: F.shiftright(F.shiftleft(h, 32), 32).cast("int")))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two hash sets; 1 for two empty ones."""
    both, total = F.size(F.array_intersect(a, b)), F.size(a) + F.size(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(both / (total - both))


def digest(prints: Column) -> Column:
    """A fingerprint as 32 hex digits, from its hashes and positions."""
    return F.lower(F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(seed), prints)), 16, "0") for seed in (1, 2)]))


def _numbers(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def with_next(docs: DataFrame, key: str, tie: str, payload: list[str], parts: int | None = None) -> DataFrame:
    """Adds struct ``next``: the ``payload`` of the following row in descending ``key``; after the last row the first.

    The order is global, yet a task sees only a slice of it.  Quantiles of the
    key (an integer; it is read alone for that) cut the rows into slices of about
    equal size.  A window runs inside each slice, and the first row of a slice is
    also sent to the slice before it, so the payload is shuffled once.  Rows
    without a key come last, sliced and ordered by the 64-bit hash ``tie``, which
    also orders rows of equal key.
    """
    spark = docs.sparkSession
    parts = parts or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    k, t = F.col(key), F.col(tie)
    got = docs.agg(F.percentile_approx(key, [i / parts for i in range(1, parts)], 20 * parts).alias("c"),
                   F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    slice_no = F.lit(0)
    if got["c"]:
        # the cuts are found through a grid of equal steps, so that a row compares with few of them
        cuts, step = sorted(set(got["c"])), max(1, (got["hi"] - got["lo"]) // parts + 1)
        cell = ((k - F.lit(got["lo"])) / F.lit(step)).cast("int")
        first, i = [], 0
        for c in range((got["hi"] - got["lo"]) // step + 2):
            while i < len(cuts) and cuts[i] < got["lo"] + c * step:
                i += 1
            first.append(i)
        begin, end = F.element_at(_numbers(first), cell + 1), F.element_at(_numbers(first), cell + 2)
        within = F.slice(_numbers(cuts), (begin + 1).cast("int"), (end - begin).cast("int"))
        slice_no = (begin + F.size(F.filter(within, lambda c: c <= k))).cast("int")
    keyless = (F.floor((t / F.lit(2.0 ** 64) + 0.5) * parts) - (parts + 2)).cast("int")
    sliced = docs.withColumn("slice", F.when(k.isNull(), keyless).otherwise(slice_no))
    heads = (sliced.where(k.isNotNull()).groupBy("slice").agg(F.max(key).alias("head"), F.lit(None).cast("long").alias("head_tie"))
             .unionByName(sliced.where(k.isNull()).groupBy("slice")
                          .agg(F.lit(None).cast("long").alias("head"), F.max(tie).alias("head_tie"))))
    order = Window.orderBy("slice")  # one row per slice
    heads = stash(heads.withColumn("into", F.coalesce(F.lead("slice").over(order), F.first("slice").over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))).drop("slice"), "next-heads")
    at_head = F.when(k.isNull(), t == F.col("head_tie")).otherwise(k == F.col("head"))
    # equi-join on the key, 0 for none
    placed = sliced.join(heads.withColumn("head_key", F.coalesce("head", F.lit(0))),
                         (F.coalesce(k, F.lit(0)) == F.col("head_key")) & (k.isNull() == F.col("head").isNull()) & at_head,
                         "left")
    places = F.array(F.struct(F.col("slice").alias("at"), F.lit(False).alias("guest")),
                     F.struct(F.col("into").alias("at"), F.lit(True).alias("guest")))
    rows = (placed.withColumn("place", F.explode(F.when(F.col("into").isNull(), F.slice(places, 1, 1)).otherwise(places)))
            .select(*docs.columns, "place.at", "place.guest"))
    follow = Window.partitionBy("at").orderBy("guest", k.desc_nulls_last(), t.desc())
    return (rows.withColumn("next", F.lead(F.struct(*payload)).over(follow)).where(~F.col("guest"))
            .drop("at", "guest"))


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = K, w: int = W) -> DataFrame:
    """(key, prints): the fingerprint of every document."""
    return docs.select(F.col(f"`{key}`").alias(key), fingerprint(docs[f"`{text}`"], k, w).alias("prints"))


def edited_comparison(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = K, w: int = W) -> DataFrame:
    """Every document's fingerprint against its edited text's and the next document's.

    The edited text has its last ``n_chars // 2`` code points replaced by the
    first as many (or all) of the next document's, in descending key order.
    Returns (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next) with digests for the fingerprints; ``fingerprints``
    has them in full.  Only text and hash set are shuffled.

    * null text: empty.  No words: empty fingerprint, likeness 1 to another empty one, 0 to any other.
    * null key: after all others, ordered by text.  Repeated rows follow one another.
    * one document: the next one is itself.  An empty table gives an empty result.
    """
    body = F.coalesce(docs[f"`{text}`"], F.lit(""))
    base = docs.select(docs[f"`{key}`"].cast("long").alias("doc_id"), body.alias("body"), text_key(body).alias("tie"),
                       F.length(body).cast("long").alias("n_chars"), fingerprint(body, k, w).alias("prints"))
    base = base.select("doc_id", "body", "tie", "n_chars", digest(F.col("prints")).alias("fingerprint"),
                       hashes(F.col("prints")).alias("hs"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("body", F.lit(1), F.col("n_chars").cast("int") - half),
                      F.substring("next.body", F.lit(1), half))
    out = (with_next(base, "doc_id", "tie", ["body", "hs"])
           .select("doc_id", "n_chars", "fingerprint", "hs", F.col("next.hs").alias("next_hs"), edited.alias("edited"))
           .withColumn("edited_prints", fingerprint(F.col("edited"), k, w)))
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                      digest(F.col("edited_prints")).alias("edited_fingerprint"),
                      likeness(F.col("hs"), hashes(F.col("edited_prints"))).alias("near_edited"),
                      likeness(F.col("hs"), F.col("next_hs")).alias("near_next"))
