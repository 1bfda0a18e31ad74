"""Column expressions (string, date, set rendering, call-by-name)."""

from linkgraph.functions.expressions import (  # noqa: F401
    CLEAN_TEXT_PATTERN,
    DEFAULT_DATE_FORMAT,
    EPOCH_TEXT_FORMAT,
    call_function,
    clean_text,
    collect_set_string,
    concat_sep,
    epoch_seconds,
    epoch_to_text,
    has_digit,
    last_by_order,
    length_between,
    parse_date,
    parse_timestamp,
    set_string,
    stringify,
)
