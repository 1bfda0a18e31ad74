"""Column-level building blocks (built-in Spark functions only, no UDFs).

Every helper returns a ``Column`` so it stays inside whole-stage codegen and
can be combined freely in one ``select``.  Parsing helpers use the ``try_*``
family so a malformed value becomes NULL whether or not
``spark.sql.ansi.enabled`` is set.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's behaviour) -------------------
# Characters kept by the text cleaner: digits, Latin letters, Hebrew letters, space.
CLEAN_TEXT_PATTERN = r"[^0-9a-zA-Zא-ת ]"
# Default day-first date format of the date parser.
DEFAULT_DATE_FORMAT = "dd/MM/yyyy"
# Text form of epoch timestamps in the metric log.
EPOCH_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Element separator of rendered sets ("[a, b]") and of stringified arrays ("[a,b]").
SET_SEPARATOR = ", "
STRINGIFY_SEPARATOR = ","
# ---------------------------------------------------------------------------

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def concat_sep(cols: Sequence[str | Column], sep: str | None = None) -> Column:
    """Concatenate columns as text, optionally with a separator.

    Unlike ``concat_ws`` the result is NULL as soon as one part is NULL
    (the reference builds edge keys this way, so a missing part yields no key).
    """
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i and sep:
            parts.append(F.lit(sep))
        parts.append(as_col(c).cast("string"))
    return F.concat(*parts)


def set_string(arr: str | Column) -> Column:
    """Render an array as ``[a, b]`` with its elements sorted (deterministic)."""
    return F.concat(F.lit("["), F.array_join(F.array_sort(as_col(arr)), SET_SEPARATOR), F.lit("]"))


def collect_set_string(c: str | Column, injective_text: bool = False) -> Column:
    """Aggregate: distinct non-null values of ``c`` as text, rendered ``[a, b]``; empty -> ``[]``.

    ``injective_text=True`` (integers, dates, strings: distinct values have distinct
    text) collects the raw values and turns only the distinct ones into text.
    """
    if injective_text:
        return set_string(F.transform(F.collect_set(as_col(c)), lambda x: x.cast("string")))
    return set_string(F.collect_set(as_col(c).cast("string")))


def day_text(c: str | Column) -> Column:
    """Timestamp -> ``yyyy-MM-dd`` text (a cast, cheaper than a pattern formatter)."""
    return as_col(c).cast("date").cast("string")


def stringify(arr: str | Column) -> Column:
    """``[`` + comma-joined elements (nulls skipped, NULL array -> ``[]``) + ``]``."""
    return F.concat(F.lit("["), F.concat_ws(STRINGIFY_SEPARATOR, as_col(arr)), F.lit("]"))


def clean_text(c: str | Column) -> Column:
    """Remove everything but digits, Latin/Hebrew letters and spaces."""
    return F.regexp_replace(as_col(c), CLEAN_TEXT_PATTERN, "")


def has_digit(c: str | Column) -> Column:
    """True when the text contains at least one digit."""
    return as_col(c).cast("string").rlike("[0-9]")


def length_between(c: str | Column, min_len: int, max_len: int) -> Column:
    """Inclusive character-length bounds (NULL text -> NULL -> row dropped by a filter)."""
    n = F.length(as_col(c))
    return (n >= F.lit(min_len)) & (n <= F.lit(max_len))


def parse_date(c: str | Column, fmt: str = DEFAULT_DATE_FORMAT) -> Column:
    return F.try_to_date(as_col(c), fmt)


def _has_zone(fmt: str) -> bool:
    """Whether a datetime pattern has a zone or offset letter outside of quotes."""
    return any(c in "VzOXxZ" for part in fmt.split("'")[::2] for c in part)


def _as_utc(c: str | Column, fmt: str) -> Column:
    """Instant of a text read as UTC wall-clock time, whatever the session time zone."""
    if _has_zone(fmt):
        return F.try_to_timestamp(as_col(c), F.lit(fmt))
    return F.try_to_timestamp(F.concat(as_col(c), F.lit(" +00:00")), F.lit(f"{fmt} xxx"))


def parse_timestamp(c: str | Column, fmt: str, ntz: bool = False) -> Column:
    """Parse text by ``fmt``; NULL on bad input.

    ``ntz=True`` returns ``TIMESTAMP_NTZ``: the wall-clock value, independent of the
    session time zone (times that a zone's clock change skips included).
    """
    if not ntz:
        return F.try_to_timestamp(as_col(c), F.lit(fmt))
    return F.timestamp_add("MICROSECOND", F.unix_micros(_as_utc(c, fmt)), F.expr(_EPOCH_NTZ))


def epoch_seconds(c: str | Column, fmt: str) -> Column:
    """Seconds since 1970-01-01 of the wall-clock text read as UTC (NULL on bad input)."""
    return F.unix_seconds(_as_utc(c, fmt))


def epoch_to_text(c: str | Column, fmt: str = EPOCH_TEXT_FORMAT) -> Column:
    """Float epoch seconds -> UTC wall-clock text (fraction dropped, like ``strftime``)."""
    secs = F.floor(as_col(c).cast("double")).cast("bigint")
    return F.date_format(F.timestamp_add("SECOND", secs, F.expr(_EPOCH_NTZ)), fmt)


#: Functions of ``pyspark.sql.functions`` that take columns and return one.
_FUNCTIONS = frozenset(n for n in F.__all__ if n not in ("udf", "udtf", "pandas_udf", "arrow_udf", "arrow_udtf", "broadcast",
                                                         "call_function", "call_udf", "UserDefinedFunction",
                                                         "UserDefinedTableFunction", "PandasUDFType"))


def call_function(name: str, args: Any = None) -> Column:
    """Call any built-in function by name.

    ``args`` as list -> positional, dict -> keyword, anything else -> one argument
    (strings are column names, as in ``pyspark.sql.functions``).  Names without a
    Python wrapper go through ``F.call_function``.
    """
    fn = getattr(F, name, None) if name in _FUNCTIONS else None
    if fn is None:
        if isinstance(args, dict):
            raise ValueError(f"keyword arguments need a Python wrapper; {name!r} has none")
        pos = args if isinstance(args, list) else ([] if args is None else [args])
        return F.call_function(name, *[a if isinstance(a, (str, Column)) else F.lit(a) for a in pos])
    if isinstance(args, list):
        return fn(*args)
    if isinstance(args, dict):
        return fn(**args)
    if args is None:
        return fn()
    return fn(args)


def survivors(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], last: bool = False) -> DataFrame:
    """One row per key: the first (or ``last``) by ``order``, then by the other columns; NULL comes before every value.

    Row number 1 of a window by key.  Spark applies the limit on both sides of the
    shuffle (window group limit), so a task sends one row per key at most and a hot
    key is never gathered, and no row is packed into a struct to be compared.
    """
    named = [o for o in order if isinstance(o, str)]
    sort = [*[as_col(o) for o in order], *[F.col(c) for c in df.columns if c not in keys and c not in named]]
    if not sort:
        return df.dropDuplicates()
    at = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() if last else c.asc_nulls_first() for c in sort])
    return df.withColumn("__at__", F.row_number().over(at)).where(F.col("__at__") == 1).drop("__at__")


def last_by_order(value: Column, order: Iterable[str | Column]) -> Column:
    """Aggregate: ``value`` from the row with the largest ``order`` tuple, then the largest value (last write wins)."""
    return F.max(F.struct(*[as_col(o).alias(f"__order{i}__") for i, o in enumerate(order)], value.alias("__value__")))["__value__"]
