from tallybook.functions.calendar import (
    offset_of,
    parse_suffix,
    partition_id,
    partition_offset,
    shift,
    split_suffix,
)
from tallybook.functions.numbers import money_sum, pct_change_sql, round2
from tallybook.functions.text import (
    category_path,
    extract_or_null,
    first_of,
    format_size,
    title_case,
)

__all__ = [
    "category_path",
    "extract_or_null",
    "first_of",
    "format_size",
    "money_sum",
    "offset_of",
    "parse_suffix",
    "partition_id",
    "partition_offset",
    "pct_change_sql",
    "round2",
    "shift",
    "split_suffix",
    "title_case",
]
