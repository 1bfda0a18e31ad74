"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkgraph.session import cut_lineage

#: A word: a run of characters outside space, tab, line feed, vertical tab, form feed, carriage return.
WORD_RE = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared checkpoint folder and read it back.

    The schema is given on the read, so an empty table comes back as one.
    """
    return cut_lineage(df, name)


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Bound the rows of one Arrow batch, so that a Python worker holds few long texts at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def lower_ascii(text: Column) -> Column:
    """A-Z to lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    An expression used inside a lambda would be evaluated again for every
    element; a one-element array binds it to a lambda variable instead.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def text_key(text: Column) -> Column:
    """64-bit hash of a text (null counts as empty)."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def largest(table: DataFrame, by: list[str], most: int, count: str = "n") -> DataFrame:
    """Of each group ``by`` the rows with the largest ``count``, at most ``most``.

    Whole classes of counts (eighths of a power of 2) stay or go, so a group is cut
    by a threshold found from its few hundred class sizes, and never sorted.
    """
    size = F.floor(F.log2(F.col(count)) * 8)
    down = Window.partitionBy(*by).orderBy(F.desc("size"))
    cut = (table.groupBy(*by, size.alias("size")).agg(F.count("*").alias("rows"))
           .withColumn("upto", F.sum("rows").over(down)).where(F.col("upto") <= most)
           .groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(F.min("size").alias("_least")))
    cut = stash(cut, "largest")
    at = size >= F.col("_least")
    for c in by:
        at = (F.col(c) == F.col(f"_{c}")) & at
    return table.join(cut, at).select(*table.columns)


def split_largest(table: DataFrame, most: int, count: str = "n") -> tuple[DataFrame, DataFrame]:
    """``table`` in two: the rows with the largest ``count``, at most ``most`` (whole classes, as in ``largest``), and all others."""
    size = F.floor(F.log2(F.col(count)) * 8)
    least, upto = 1 << 30, 0
    for r in sorted(table.groupBy(size.alias("size")).agg(F.count("*").alias("rows")).collect(), reverse=True):
        upto += r["rows"]
        if upto > most:
            break
        least = r["size"]
    return table.where(size >= least), table.where(size < least)
