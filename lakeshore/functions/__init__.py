"""Column-level helpers (all built-in Spark expressions)."""

from lakeshore.functions.attrs import (
    DATE_MAP,
    NUM_MAP,
    TEXT_MAP,
    attr,
    date_attrs,
    null_map,
    num_attrs,
    text_attrs,
)
from lakeshore.functions.keys import (
    all_not_null,
    any_null,
    bucket_of,
    key_text,
    null_safe_join_key,
    surrogate_key,
)
from lakeshore.functions.marks import as_literal, epoch_literal, mark_expr

__all__ = [
    "DATE_MAP",
    "NUM_MAP",
    "TEXT_MAP",
    "all_not_null",
    "any_null",
    "as_literal",
    "attr",
    "bucket_of",
    "date_attrs",
    "epoch_literal",
    "key_text",
    "mark_expr",
    "null_map",
    "null_safe_join_key",
    "num_attrs",
    "surrogate_key",
    "text_attrs",
]
