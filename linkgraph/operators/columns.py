"""Projection and column-assignment steps (P1-P10) and text/date steps.

Every step is ``op(df, ...) -> DataFrame`` and lazy, so steps chain with
``df.transform(op, ...)`` and Catalyst collapses them into one projection.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkgraph.functions import expressions as X

log = logging.getLogger(__name__)

# --- fixed values: array columns with these endings are rendered as text on save
_STRINGIFY_SUFFIXES = ("_att", "_set")


def _listify(v: str | Sequence[str] | None) -> list[str]:
    if v is None:
        return []
    return [v] if isinstance(v, str) else list(v)


# ---------------------------------------------------------------- P1-P8 ----

def use_cols(df: DataFrame, keep_cols: Sequence[str]) -> DataFrame:
    """Keep the listed columns in the table's own order; unknown names are an error."""
    keep = _listify(keep_cols)
    missing = [c for c in keep if c not in df.columns]
    if missing:
        raise ValueError(f"use_cols: unknown columns {missing}; table has {df.columns}")
    return df.select(*[c for c in df.columns if c in set(keep)])


def drop_cols(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop the listed columns; unknown names are ignored."""
    return df.drop(*_listify(subset))


def rename_cols(df: DataFrame, renamed_cols: Mapping[str, str]) -> DataFrame:
    """Rename pairs in order, so ``a->b`` then ``b->c`` chains; unknown names warn only."""
    if not isinstance(renamed_cols, Mapping):
        raise ValueError("rename_cols: renamed_cols must be a dict {old: new}")
    current = list(df.columns)
    for old, new in renamed_cols.items():
        if old in current:
            current = [new if c == old else c for c in current]
        else:
            log.warning("rename_cols: column %r not found, skipped", old)
    # withColumnsRenamed applies the pairs sequentially as well
    return df.withColumnsRenamed(dict(renamed_cols))


def add_literal(df: DataFrame, col_new: str, value: Any) -> DataFrame:
    """Add (or replace) a constant column."""
    return df.withColumn(col_new, F.lit(value))


def assign(df: DataFrame, col: str, value: Column) -> DataFrame:
    """Add or replace a column by expression."""
    return df.withColumn(col, value)


def assign_fn(df: DataFrame, col: str, func: str, attr: Any = None) -> DataFrame:
    """Add or replace a column by built-in function name + arguments."""
    return df.withColumn(col, X.call_function(func, attr))


def _cast_expr(c: str, src: T.DataType, target: T.DataType, type_: str) -> Column:
    if isinstance(src, T.StringType) and isinstance(target, T.IntegralType):
        # text "3.7" -> 3 under either ANSI setting (legacy casts truncate, ANSI try_cast
        # would give NULL): go through a decimal, then truncate
        return F.col(c).try_cast("decimal(38,10)").try_cast(type_)
    return F.col(c).try_cast(type_)


def astype(df: DataFrame, type_: str, subset: Sequence[str]) -> DataFrame:
    """Cast each listed column to ``type_`` (DDL name); bad values become NULL (try_cast),
    with the same result whether or not ANSI mode is on."""
    cols = set(_listify(subset))
    target = T.DataType.fromDDL(type_)
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[_cast_expr(c, types[c], target, type_).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


# ---------------------------------------------------------------- P9, A5 ---

def null_profile(df: DataFrame, by_column: bool = False) -> DataFrame:
    """One row: number of NULLs per column.

    By default a single pass over all columns.  ``by_column`` is for tables stored as
    Parquet: each column is scanned alone for its NULL rows, so a row group whose
    footer says that the column has no NULL is not read, and one without statistics
    is.  A table of few NULLs is profiled from footers; at worst each column is read once.
    """
    if not by_column:
        return df.agg(*[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in df.columns])
    counts = reduce(DataFrame.unionAll, [df.select(c).where(F.col(c).isNull()).select(F.lit(i).alias("i")) for i, c in enumerate(df.columns)])
    # one row per column and task is shuffled
    counts = counts.groupBy("i").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(*[F.coalesce(F.sum(F.when(F.col("i") == i, F.col("n"))), F.lit(0)).alias(c) for i, c in enumerate(df.columns)])


def drop_null_cols(df: DataFrame, threshold: int | None = None, by_column: bool = False) -> DataFrame:
    """Drop columns whose NULL count equals ``threshold`` (default: the row count).

    The output schema depends on the data, so this runs one aggregate (a single
    row comes back to the driver).  On an empty table nothing is dropped.
    ``by_column``: see ``null_profile``; the row count then comes from the footers.
    """
    if not df.columns:
        return df
    if by_column:
        rows, nulls = df.count(), list(null_profile(df, by_column=True).first())
    else:
        rows, *nulls = df.agg(F.count(F.lit(1)), *[F.count(F.when(F.col(c).isNull(), F.lit(1))) for c in df.columns]).first()
    if rows == 0:
        return df
    limit = threshold if threshold else rows
    return df.drop(*[c for c, n in zip(df.columns, nulls, strict=True) if n == limit])


# ---------------------------------------------------------------- P10 ------

def order_node_ids(df: DataFrame, node1: Mapping[str, Any], node2: Mapping[str, Any]) -> DataFrame:
    """Order paired endpoint columns so the first ID is the greater one.

    ``node1``/``node2`` are ``{id_col: attr | [attrs]}``.  When ``id1 > id2`` is
    false *or unknown (NULL)* the two endpoints swap, attributes travelling with
    their ID.  The moved columns come last, pairwise (id1, id2, att1, att2, ...).
    """
    (id1, att1), = node1.items()
    (id2, att2), = node2.items()
    cols1 = [id1] + _listify(att1)
    cols2 = [id2] + _listify(att2)
    if len(cols1) != len(cols2):
        raise ValueError("order_node_ids: both endpoints need the same number of attributes")
    keep_first = F.coalesce(F.col(id1) > F.col(id2), F.lit(False))
    moved = set(cols1) | set(cols2)
    out = [F.col(c) for c in df.columns if c not in moved]
    for a, b in zip(cols1, cols2):
        out.append(F.when(keep_first, F.col(a)).otherwise(F.col(b)).alias(a))
        out.append(F.when(keep_first, F.col(b)).otherwise(F.col(a)).alias(b))
    return df.select(*out)


# ---------------------------------------------------------------- X1-X10 ---

def concat_cols(df: DataFrame, col_new: str, subset: Sequence[str], sep: str | None = None) -> DataFrame:
    """New column = parts joined by ``sep``; NULL when any part is NULL."""
    return df.withColumn(col_new, X.concat_sep(_listify(subset), sep))


def lpad_col(df: DataFrame, col_new: str, col_existing: str, length: int, pad: str) -> DataFrame:
    """Left-pad to ``length`` with ``pad``; longer values are cut to ``length``."""
    return df.withColumn(col_new, F.lpad(F.col(col_existing).cast("string"), length, pad))


def clean_cols(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    cols = set(_listify(subset))
    return df.select(*[X.clean_text(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def stringify_cols(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    cols = set(_listify(subset))
    return df.select(*[X.stringify(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def auto_stringify(df: DataFrame) -> DataFrame:
    """Stringify every *array* column whose name ends in ``_att`` or ``_set``.

    Columns already rendered as text are left alone (no ``[[a, b]]``).
    """
    cols = [f.name for f in df.schema.fields
            if f.name.endswith(_STRINGIFY_SUFFIXES) and isinstance(f.dataType, T.ArrayType)]
    return stringify_cols(df, cols) if cols else df


def to_timestamp_cols(df: DataFrame, cols: Sequence[str], fmt: str, ntz: bool = False) -> DataFrame:
    """Parse the listed text columns in place; bad values -> NULL."""
    s = set(_listify(cols))
    return df.select(*[X.parse_timestamp(c, fmt, ntz).alias(c) if c in s else F.col(c) for c in df.columns])


def to_date_cols(df: DataFrame, cols: Sequence[str], fmt: str = X.DEFAULT_DATE_FORMAT) -> DataFrame:
    s = set(_listify(cols))
    return df.select(*[X.parse_date(c, fmt).alias(c) if c in s else F.col(c) for c in df.columns])


def to_epoch_cols(df: DataFrame, cols: Sequence[str], fmt: str) -> DataFrame:
    """Text timestamps -> seconds since epoch (text read as UTC); bad values -> NULL."""
    s = set(_listify(cols))
    return df.select(*[X.epoch_seconds(c, fmt).alias(c) if c in s else F.col(c) for c in df.columns])
