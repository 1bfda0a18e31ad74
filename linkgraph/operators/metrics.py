"""Metric drift over an event log.

The reference reads an event log, keeps the numeric metadata of each event,
pivots one metric per asset over time and takes the percent change.  Here the
log is parsed with ``from_json`` and kept in *long* form (time bucket, key,
label, value): the percent change is a ``lag`` per key, the wide table a pivot
over an explicit key list (no driver-side discovery of pivot values).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkgraph.functions import expressions as X
from linkgraph.session import cut_lineage

# --- fixed values: event-log record schema ----------------------------------
EVENT_SCHEMA = ("timestamp DOUBLE, asset_key STRING, "
                "metadata_entries ARRAY<STRUCT<label: STRING, value: STRING>>")
# ---------------------------------------------------------------------------


def metric_entries(log: DataFrame, event_col: str = "event", keep: Sequence[str] = ()) -> DataFrame:
    """One row per *numeric* metadata entry of each logged event.

    Output: ``keep``, ``ts_text`` (UTC ``yyyy-MM-dd HH:mm:ss``), ``asset_key``,
    ``label``, ``value`` (double).  Entries whose value is not a number are skipped.
    """
    keep = list(keep)
    ev = log.select(*keep, F.from_json(F.col(event_col), EVENT_SCHEMA).alias("__e__"))
    ent = ev.select(*keep, F.col("__e__.timestamp").alias("__ts__"),
                    F.col("__e__.asset_key").alias("asset_key"),
                    F.explode(F.col("__e__.metadata_entries")).alias("__m__"))
    val = F.col("__m__.value").try_cast("double")
    return (ent.where(val.isNotNull())
               .select(*keep, X.epoch_to_text(F.col("__ts__")).alias("ts_text"), "asset_key",
                       F.col("__m__.label").alias("label"), val.alias("value")))


def select_keys(df: DataFrame, keys: DataFrame | Sequence[str], key_col: str = "asset_key") -> DataFrame:
    """Rows whose key is in a key list or key table (semi-join for a table)."""
    if isinstance(keys, DataFrame):
        return df.join(keys.select(F.col(keys.columns[0]).alias(key_col)).distinct(), on=key_col, how="left_semi")
    return df.where(F.col(key_col).isin(list(keys)))


def bucket(ts: str | Column, unit: str = "day") -> Column:
    """Truncate a timestamp (or its text) to a time bucket, as text."""
    c = F.col(ts) if isinstance(ts, str) else ts
    fmt = {"day": "yyyy-MM-dd", "hour": "yyyy-MM-dd HH:00:00", "minute": "yyyy-MM-dd HH:mm:00"}[unit]
    return F.date_format(F.date_trunc(unit, c.cast("timestamp_ntz")), fmt)


def latest_per_bucket(df: DataFrame, bucket_col: str, key_col: str, value_col: str,
                      order: Sequence[str]) -> DataFrame:
    """Last write wins: the value of the latest row (by ``order``) per (bucket, key)."""
    rows = df.select(*dict.fromkeys([bucket_col, key_col, *order, value_col]))
    return X.survivors(rows, [bucket_col, key_col], order, last=True).select(bucket_col, key_col, value_col)


#: Rows of a series that one task may order.
SLICE_ROWS = 1_000_000


def pct_change(series: DataFrame, key_col: str, order_col: str, value_col: str,
               out_col: str = "pct_change", chunk: Column | None = None, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``value / previous value - 1`` per key in ``order_col`` order; first row and
    division by zero give NULL.

    The series is stored first.  If it has more than ``slice_rows`` rows, it is cut into
    ranges of (key, time) of about that many, so that one key with all rows is spread
    like many keys: the previous value is looked up inside each (key, slice), and the
    first row of a slice takes the last value of the key's previous slice, found over a
    summary of one row per key and slice.  A ``chunk`` column that orders like
    ``order_col``, e.g. the month of a day, gives the slices instead.
    """
    series = cut_lineage(series, "series")  # read several times below
    if chunk is not None:
        sliced = series.withColumn("__slice__", chunk)
    elif (n := series.count()) <= slice_rows:  # from the file footers
        sliced = series.withColumn("__slice__", F.lit(0))
    else:
        # rows of one (key, time) stay together; a slice's number follows the order of its range
        sliced = cut_lineage(series.repartitionByRange(-(-n // slice_rows), key_col, order_col)
                             .withColumn("__slice__", F.spark_partition_id()), "series-slices")
    return _change_by_slice(sliced, key_col, order_col, value_col, out_col)


def _change_by_slice(sliced: DataFrame, key_col: str, order_col: str, value_col: str, out_col: str) -> DataFrame:
    """``pct_change`` of rows whose ``__slice__`` orders like time within a key."""
    columns = [c for c in sliced.columns if c != "__slice__"]
    w = Window.partitionBy(key_col, "__slice__").orderBy(order_col)
    rows = sliced.select(*columns, "__slice__", F.lag(value_col).over(w).alias("__prev__"),
                         (F.row_number().over(w) == 1).alias("__first__"))
    ends = (sliced.groupBy(key_col, "__slice__").agg(F.max_by(F.col(value_col), F.col(order_col)).alias("__last__"))
            .select(F.col(key_col).alias("__key__"), F.col("__slice__").alias("__at__"),
                    F.lag("__last__").over(Window.partitionBy(key_col).orderBy("__slice__")).alias("__before__")))
    same = F.col(key_col).eqNullSafe(F.col("__key__")) & F.col("__slice__").eqNullSafe(F.col("__at__"))
    prev = F.when(F.col("__first__"), F.col("__before__")).otherwise(F.col("__prev__"))
    return (rows.join(ends, on=same, how="left")
                .select(*columns, (F.try_divide(F.col(value_col), prev) - F.lit(1.0)).alias(out_col)))


def pivot_keys(series: DataFrame, row_col: str, key_col: str, value_col: str,
               keys: Sequence[str] | None = None, dropna: bool = True,
               order: Sequence[str] | None = None) -> DataFrame:
    """Wide table: one row per ``row_col``, one column per key; rows with a missing key
    are dropped when ``dropna``.

    Without ``keys`` every key in the data gets a column: one small job lists them
    (they decide the schema).  Of several rows with one (row, key) the last by
    ``order`` counts, then the largest value."""
    if keys is None:
        keys = [r[0] for r in series.where(F.col(key_col).isNotNull()).select(key_col).distinct().orderBy(key_col).collect()]
    order = list(order or [])
    wide = series.groupBy(row_col).pivot(key_col, list(keys)).agg(X.last_by_order(F.col(value_col), order))
    return wide.dropna(how="any", subset=list(keys)) if dropna and keys else wide
