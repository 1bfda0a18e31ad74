"""Row-wise steps on streaming DataFrames.

The reference declares its inputs batch, not streaming, and has no windows,
watermarks or state.  What carries over is that its row-wise cleaning steps
(projection, rename, literal columns, casts, filters, null handling, text and
date functions) are stateless, so the same step list can clean a stream of
landing files before the batch graph jobs run.  Steps that need the whole
table (distinct, null profiling, joins-and-aggregates, windows) are refused on
a stream instead of silently buffering state.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame

from linkgraph.operators import columns as C
from linkgraph.operators import filters as Fl

STATELESS_STEPS: frozenset[Callable[..., DataFrame]] = frozenset({
    C.use_cols, C.drop_cols, C.rename_cols, C.add_literal, C.assign, C.assign_fn, C.astype,
    C.order_node_ids, C.concat_cols, C.lpad_col, C.clean_cols, C.stringify_cols, C.auto_stringify,
    C.to_timestamp_cols, C.to_date_cols, C.to_epoch_cols,
    Fl.filter_query, Fl.filter_isin, Fl.filter_length, Fl.filter_has_digits, Fl.dropna, Fl.fillna,
    Fl.replace_values, Fl.time_range,
})

Step = tuple[Callable[..., DataFrame], Mapping[str, Any]]


def apply_steps(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Apply ``(operator, kwargs)`` steps in order; on a stream only stateless ones."""
    for fn, kwargs in steps:
        if df.isStreaming and fn not in STATELESS_STEPS:
            raise ValueError(f"{fn.__name__} needs the whole table and cannot run on a stream")
        df = fn(df, **dict(kwargs))
    return df


def clean_stream(df: DataFrame, steps: Sequence[Step], sink_path: str, checkpoint: str,
                 fmt: str = "parquet", trigger_once: bool = True):
    """Run the steps on a streaming source and append the rows to ``sink_path``.

    ``checkpoint`` must be on shared storage (it holds the stream's progress,
    so a restarted query resumes where it stopped).  Returns the started query.
    """
    cleaned = apply_steps(df, steps)
    writer = (cleaned.writeStream.format(fmt).option("path", sink_path)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
