"""Joins, unions and small aggregates.

Join strategy is left to Catalyst/AQE: a side is broadcast only when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (checked at
plan time from statistics and again at run time by AQE); anything bigger is a
shuffled sort-merge join, with AQE splitting skewed partitions.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: Spark's names of join kinds
JOIN_TYPES = ("inner", "cross", "outer", "full", "full_outer", "left", "left_outer",
              "right", "right_outer", "left_semi", "left_anti")


def join_df(df: DataFrame, other: DataFrame, on: str | Sequence[str], how: str = "inner",
            distinct: bool = True) -> DataFrame:
    """Equi-join on common column name(s), then drop duplicate rows.

    ``how='cross'`` with a key behaves as an inner join on that key.
    """
    if how not in JOIN_TYPES:
        raise ValueError(f"join_df: how must be one of {JOIN_TYPES}, got {how!r}")
    keys = [on] if isinstance(on, str) else list(on)
    joined = df.join(other, on=keys, how="inner" if how == "cross" else how)
    return joined.dropDuplicates() if distinct else joined


def enrich(df: DataFrame, lookups: Sequence[tuple[DataFrame, str | Sequence[str]]],
           how: str = "left") -> DataFrame:
    """Chain of enrichment joins (each lookup joined on its key columns)."""
    return reduce(lambda acc, lk: acc.join(lk[0], on=lk[1], how=how), lookups, df)


#: Rows that one task of a join and the aggregates behind it should take.
TASK_ROWS = 500_000


def task_parts(spark: SparkSession, rows: int) -> int | None:
    """Partitions that give each task about ``TASK_ROWS`` of ``rows`` rows, or None where the session's own number does.

    Adaptive execution joins small partitions up to a size in compressed bytes (64 MB,
    which may be millions of narrow rows) but keeps at least one for each core; a number
    given to ``repartition`` stays.
    """
    parts = math.ceil(rows / TASK_ROWS)
    return parts if parts > spark.sparkContext.defaultParallelism else None


def dealt_alike(dfs: Sequence[DataFrame], on: str | Sequence[str]) -> list[DataFrame]:
    """Tables to be joined on ``on``, dealt by it so that a task's share of the largest stays about ``TASK_ROWS`` rows,
    however large the tables are; small ones come back as they are.

    The join and aggregates by a superset of ``on`` need no further exchange, and what a task
    holds does not grow with the input.  Counts the rows of each table (Parquet: from the footers).
    """
    spark = dfs[0].sparkSession
    parts = task_parts(spark, max(df.count() for df in dfs))
    return [df.repartition(parts, *([on] if isinstance(on, str) else on)) if parts else df for df in dfs]


def _common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    if a == b:
        return None
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return None  # Spark widens numerics itself
    return T.StringType()


def union_by_name(df1: DataFrame, df2: DataFrame) -> DataFrame:
    """UNION ALL by column name over the union of columns, sorted alphabetically.

    Missing columns are NULL.  Same name with incompatible types (not both
    numeric) -> both sides cast to string, so the result never depends on
    ANSI string->number coercion.
    """
    t1 = {f.name: f.dataType for f in df1.schema.fields}
    t2 = {f.name: f.dataType for f in df2.schema.fields}
    to_string = {c for c in t1.keys() & t2.keys() if _common_type(t1[c], t2[c]) is not None}
    cols = sorted(set(t1) | set(t2))

    def side(df: DataFrame, types: Mapping[str, T.DataType]) -> DataFrame:
        return df.select(*[
            (F.col(c).cast("string") if c in to_string else F.col(c)).alias(c) if c in types
            else F.lit(None).cast(t1.get(c) or t2[c]).alias(c)
            for c in cols
        ])

    return side(df1, t1).unionByName(side(df2, t2))


def union_all_by_name(dfs: Sequence[DataFrame]) -> DataFrame:
    """Fold ``union_by_name`` over a list of tables."""
    return reduce(union_by_name, dfs)


def union_tagged(frames: Sequence[tuple[Mapping[str, Any], DataFrame]]) -> DataFrame:
    """Concatenate tables, each tagged with literal key columns (e.g. competition, season)."""
    tagged = [df.select(*[F.lit(v).alias(k) for k, v in tags.items()], *df.columns)
              for tags, df in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def row_count(df: DataFrame) -> DataFrame:
    """Row count as a one-row table (lazy; the caller decides when to run it)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def distinct_keys(df: DataFrame, col: str, contains: str = "") -> DataFrame:
    """Distinct non-empty values of ``col`` containing ``contains``."""
    c = F.col(col)
    return (df.select(c.alias(col))
              .where(c.isNotNull() & (c != "") & c.contains(contains))
              .distinct())
