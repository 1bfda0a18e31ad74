"""SimHash near-duplicates: tiled exact comparison of 64-bit fingerprints.

Distinct fingerprints are sorted into tiles by the population counts of their
four 16-bit quarters and every pair of tiles is compared in full, by exclusive-or
and bit counts over numpy arrays, unless the tiles' population counts alone differ
by more than the radius (each differing bit changes one quarter's count by one, so
such a pair of tiles holds no link).  Of the links found in a pair of tiles a
spanning forest goes on, which keeps every component and stays linear in the
tiles' rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkgraph.llm.common import small_batches, stash, text_key
from linkgraph.llm.components import components

#: Words of a shingle and largest number of differing bits of a link.
SHINGLE, RADIUS = 4, 4
#: Most fingerprints of a tile; larger tiles are cut, and the pieces compared with each other.
TILE = 4096
SEED = 42
QUARTERS = (48, 32, 16, 0)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a text as a signed integer; 0 without words."""
    if not text:
        return 0
    words = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate(([0], ends[: n - 1])).tolist()
    stops = (ends[len(words) - n:] - 1).tolist()
    joined = b" ".join(words)
    h = xxhash.xxh64_intdigest
    hs = np.fromiter([h(joined[i:j], SEED) for i, j in zip(starts, stops, strict=True)], np.uint64, n)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):  # bounded memory for very long texts
        ones += np.unpackbits(hs[k:k + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > n)
    return int(bits.view(">i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, th, fp) of every row: a hash of its text and its fingerprint, as signed 64-bit integers."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = pa.array([fingerprint(t, shingle) for t in b.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), fps], names=["doc_id", "th", "fp"])

    body = docs[f"`{text}`"].cast("string")
    return (docs.select(docs[f"`{key}`"].cast("long").alias("doc_id"), text_key(body).alias("th"), body.alias("text"))
            .mapInArrow(run, "doc_id long, th long, fp long"))


def _offsets(radius: int) -> list[tuple[int, ...]]:
    """Differences of quarter counts within the radius, one of each pair of opposites."""
    span = range(-radius, radius + 1)
    return [d for d in product(span, repeat=len(QUARTERS)) if sum(map(abs, d)) <= radius and d >= (0,) * len(QUARTERS)]


def _forest(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between two arrays of fingerprints (or within one)."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = parent.get(p, p)
            x = p
        return x

    out = []
    step = max(1, (1 << 20) // max(1, len(b)))
    ua, ub = a.view(np.uint64), b.view(np.uint64)  # bit counts of signed numbers would be those of their absolute values
    for i in range(0, len(a), step):
        near = np.bitwise_count(ua[i:i + step, None] ^ ub[None, :]) <= radius
        for x, y in zip(*np.nonzero(near), strict=True):
            u, v = i + int(x), int(y) + (0 if same else len(a))
            if u != v and (ru := find(u)) != (rv := find(v)):
                parent[rv] = ru
                out.append((int(a[u]), int(b[int(y)])))
    return out


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Distinct ``fp`` -> (a, b): links that connect all fingerprints within ``radius`` bits, directly or in steps."""
    spark = fps.sparkSession
    counts = F.struct(*[F.bit_count(F.shiftright("fp", s).bitwiseAND(F.lit(0xFFFF))).cast("int").alias(f"q{i}")
                        for i, s in enumerate(QUARTERS)])
    cells = fps.select("fp", counts.alias("cell"))
    # pieces of at most `tile` rows, dealt by a hash: the number of pieces of a cell follows its count
    pieces = stash(cells.groupBy("cell").agg(F.count("*").alias("n")).select(
        F.col("cell").alias("c2"), F.ceil(F.col("n") * 1.25 / tile).cast("int").alias("pieces")), "simhash-cells")
    tiles = stash(cells.join(pieces, F.col("cell") == F.col("c2"))
                  .withColumn("piece", F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int"))
                  .groupBy("cell", "piece").agg(F.collect_list("fp").alias("fps")), "simhash-tiles")
    q = [F.col("c2")[f"q{i}"] for i in range(len(QUARTERS))]
    moves = F.array(*[F.array(*[F.lit(x) for x in d]) for d in _offsets(radius)])
    # cells meet the cells whose counts are within the radius, of which there are 17^4 at most; then their pieces pair up
    above = pieces.select("c2", "pieces", F.explode(moves).alias("d")).select(
        F.col("c2").alias("from"), F.col("pieces").alias("n1"),
        F.struct(*[(q[i] + F.col("d")[i]).alias(f"q{i}") for i in range(len(QUARTERS))]).alias("to"))
    numbers = above.join(pieces, F.col("to") == F.col("c2")).select("from", "to", "n1", F.col("pieces").alias("n2"))
    numbers = numbers.select("from", "to", "n2", F.explode(F.sequence(F.lit(0), F.col("n1") - 1)).alias("p1"))
    numbers = numbers.select("from", "to", "p1", F.explode(F.sequence(F.lit(0), F.col("n2") - 1)).alias("p2"))
    numbers = numbers.where((F.col("from") != F.col("to")) | (F.col("p1") <= F.col("p2")))
    # only the numbers of tiles are dealt, by pairs, and the tiles come to them: a cell with many tiles is spread over
    # them, and adaptive execution does not merge partitions that are small in bytes and long in computing time
    numbers = numbers.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "from", "to", "p1", "p2")
    left = tiles.select(F.col("cell").alias("ca"), F.col("piece").alias("pa"), F.col("fps").alias("a"))
    right = tiles.select(F.col("cell").alias("cb"), F.col("piece").alias("pb"), F.col("fps").alias("b"))
    pairs = (numbers.join(left, (F.col("from") == F.col("ca")) & (F.col("p1") == F.col("pa")))
             .join(right, (F.col("to") == F.col("cb")) & (F.col("p2") == F.col("pb")))
             .select("a", "b", ((F.col("from") == F.col("to")) & (F.col("p1") == F.col("p2"))).alias("same")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b, same in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist(), strict=True):
                out += _forest(a.values.to_numpy(), b.values.to_numpy(), same, radius)
            yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=["a", "b"], dtype="int64"), preserve_index=False)

    small_batches(spark)
    return pairs.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """(doc_id, th, fp, root, component_id) of every row; component_id is the smallest doc_id reachable over links.

    ``root``, the component's smallest fingerprint, tells components apart where
    ids repeat; ``th`` is a hash of the row's text.

    * null or wordless text: fingerprint 0, linked like any other.
    * null doc_id: the row takes part; it counts as larger than any other id, so it gives
      its component_id only where no other id is there (then null).
    * repeated rows give repeated results.  An empty table gives an empty result.
    * a bit tied between 0 and 1 is 0.
    """
    fps = stash(fingerprints(docs, text, key, shingle), "simhash-fps")
    distinct = stash(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(links(distinct.select("fp"), radius))
    member = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    by_root = member.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = stash(member.join(by_root, "root").select(F.col("fp").alias("f2"), "root", "component_id"), "simhash-components")
    return fps.join(of_fp, F.col("fp") == F.col("f2")).select("doc_id", "th", "fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE,
                         radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` with all their columns, one for each component: the smallest id, then the smallest text hash.

    Of rows equal in id and text the first by their other columns stays.  Rows
    without an id stay only where their component has no id at all.
    """
    found = near_duplicates(docs, text, key, shingle, radius)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("m")
    none = F.lit(-(1 << 63))  # stands for a null id in the join
    keep = found.groupBy("root").agg(least).select(F.coalesce("m.doc_id", none).alias("_id"), F.col("m.th").alias("_th"))
    body = docs[f"`{text}`"].cast("string")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
                       F.coalesce(docs[f"`{key}`"].cast("long"), none).alias("id"), text_key(body).alias("th"))
    others = [F.col(f"row.`{c}`") for c, kind in docs.dtypes if c not in (key, text) and "map" not in kind]
    # the window runs where the join has brought the rows
    order = Window.partitionBy("id", "th").orderBy(*others, F.lit(1))
    return (rows.join(keep, (F.col("id") == F.col("_id")) & (F.col("th") == F.col("_th")))
            .withColumn("copy", F.row_number().over(order)).where("copy = 1").select("row.*"))


def hex_digits(fp: Column) -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
