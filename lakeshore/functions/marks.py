"""High-water mark expressions.

The mark is ``coalesce(max(stamp), epoch)`` and rows are taken when their stamp
is strictly greater. The epoch literal is built with the stamp column's own
type (``timestamp`` or ``timestamp_ntz``), so the comparison needs no cast.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType

EPOCH_TEXT = "1970-01-01 00:00:00"
EPOCH = dt.datetime(1970, 1, 1)


def column_type(df: DataFrame, name: str) -> DataType:
    return df.schema[name].dataType if "." not in name else df.select(name).schema[0].dataType


def epoch_literal(data_type: DataType | None = None) -> Column:
    """The epoch as a literal of the given timestamp type (UTC session)."""
    if isinstance(data_type, TimestampNTZType):
        return F.lit(EPOCH_TEXT).cast("timestamp_ntz")
    if data_type is None or isinstance(data_type, TimestampType):
        return F.lit(EPOCH_TEXT).cast("timestamp")
    return F.lit(EPOCH_TEXT).cast(data_type)


def mark_expr(stamp: str, data_type: DataType | None = None) -> Column:
    """Aggregate expression of the high-water mark of ``stamp``."""
    return F.coalesce(F.max(F.col(stamp)), epoch_literal(data_type))


def as_literal(value, data_type: DataType) -> Column:
    """A collected mark turned back into a literal of the column's type.

    A literal (not a scalar subquery) is what the JDBC and parquet scans can push
    down.
    """
    if value is None:
        return epoch_literal(data_type)
    if isinstance(value, str):
        return F.lit(value).cast(data_type)
    if isinstance(data_type, TimestampNTZType):
        return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    if isinstance(data_type, TimestampType):
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
        if value.tzinfo is not None:
            text = value.astimezone(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
        return F.lit(text).cast("timestamp")
    return F.lit(value).cast(data_type)
