"""Row filters, null handling and de-duplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkgraph.functions import expressions as X


def _listify(v):
    if v is None:
        return None
    return [v] if isinstance(v, str) else list(v)


def filter_query(df: DataFrame, query: str | Column) -> DataFrame:
    """Keep rows matching a SQL predicate (pushed to the scan by Catalyst when possible)."""
    return df.filter(query)


def filter_isin(df: DataFrame, column: str, values: Sequence[Any], not_in: bool = False) -> DataFrame:
    """``column IN values`` (or ``NOT IN``); NULL rows are dropped either way."""
    cond = F.col(column).isin(list(values))
    return df.filter(~cond if not_in else cond)


def filter_length(df: DataFrame, col: str, min_len: int, max_len: int) -> DataFrame:
    return df.filter(X.length_between(col, min_len, max_len))


def filter_has_digits(df: DataFrame, col: str = "NodeID") -> DataFrame:
    """Keep rows whose ``col`` contains at least one digit."""
    return df.filter(X.has_digit(col))


def dropna(df: DataFrame, how: str = "any", thresh: int | None = None,
           subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how=how, thresh=thresh, subset=_listify(subset))


def fillna(df: DataFrame, value: Any, subset: Sequence[str] | None = None) -> DataFrame:
    return df.fillna(value, subset=_listify(subset))


def replace_values(df: DataFrame, to_replace: Any, value: Any = None,
                   subset: Sequence[str] | None = None) -> DataFrame:
    """Replace values (scalar, list or dict); a scalar with ``value=None`` becomes NULL."""
    if isinstance(to_replace, Mapping):
        return df.replace(dict(to_replace), subset=_listify(subset))
    return df.replace(to_replace, value, subset=_listify(subset))


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None,
                    order_by: Sequence[str | Column] | None = None, keep: str = "first") -> DataFrame:
    """Remove duplicate rows; on a strict ``subset`` keep one row per key.

    The surviving row is the one with the smallest (``keep="first"``) or largest
    (``keep="last"``) ``order_by`` tuple, ties broken
    by the remaining columns (so the choice is deterministic).  Each task sends one row per key at most,
    so a hot key never lands whole in one task.
    """
    keys = _listify(subset) or []
    if not keys or set(keys) >= set(df.columns):
        return df.dropDuplicates()
    return X.survivors(df, keys, list(order_by or []), last={"first": False, "last": True}[keep])


def time_range(df: DataFrame, ts_col: str, start: Any, end: Any) -> DataFrame:
    """Keep ``start < ts <= end``."""
    return df.filter((F.col(ts_col) > F.lit(start)) & (F.col(ts_col) <= F.lit(end)))


def latest_window(df: DataFrame, ts_col: str, hours: int = 4) -> DataFrame:
    """Keep ``(max(ts) - hours, max(ts)]``.

    The maximum is a scalar subquery (one partial-aggregated row), not a join;
    ``ts <= max(ts)`` holds for every non-NULL ts, so only the lower bound is tested.
    """
    latest = df.agg(F.max(ts_col)).scalar()
    return df.filter(F.col(ts_col) > latest - F.expr(f"INTERVAL {int(hours)} HOURS"))


def peek(df: DataFrame, n: int = 5, order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """First ``n`` rows; with ``order_by`` a deterministic top-k (TakeOrderedAndProject)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def show(df: DataFrame, n: int = 5, truncate: int = 20) -> None:
    """Print the first ``n`` rows, values cut at ``truncate`` characters (fetches n rows only)."""
    df.show(n, truncate=truncate)


def sample_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    """Development sample: all rows of the first ``n`` distinct keys (ordered)."""
    first = df.select(key).where(F.col(key).isNotNull()).distinct().orderBy(key).limit(n)
    return df.join(first, on=key, how="left_semi")
