"""Key expressions: surrogate hashes, key text and hash buckets.

All are built-in Column expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshore.context import PipelineContext

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(natural_key: ColumnLike, ctx: PipelineContext | str) -> Column:
    """SHA-256 hex of ``source tag + natural key as text``.

    A NULL natural key gives a NULL surrogate (``concat`` propagates NULL), so a
    missing foreign key never joins. Ids are unique per table only: the entity
    name is not part of the hash.
    """
    prefix = ctx.key_prefix if isinstance(ctx, PipelineContext) else ctx
    return F.sha2(F.concat(F.lit(prefix), _col(natural_key).cast("string")), 256)


def key_text(keys: Sequence[ColumnLike], sep: str = "|") -> Column:
    """Text form of a (possibly composite) key for reports.

    Parts are joined with a separator and a NULL part is written as the empty
    string, so (1, 12) and (11, 2) stay apart and (1, NULL) differs from (NULL, 1).
    """
    cols = [_col(k) for k in keys]
    if len(cols) == 1:
        return cols[0].cast("string")
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def any_null(keys: Sequence[ColumnLike]) -> Column:
    """True when some key part is NULL: such a key can never match (``=``)."""
    cols = [_col(k) for k in keys]
    out = cols[0].isNull()
    for c in cols[1:]:
        out = out | c.isNull()
    return out


def all_not_null(keys: Sequence[ColumnLike]) -> Column:
    return ~any_null(keys)


def bucket_of(keys: Sequence[ColumnLike], buckets: int, spread: Sequence[ColumnLike] = ()) -> Column:
    """Hash bucket of a key: ``pmod(xxhash64(keys), buckets)``.

    Rows whose key has a NULL part can never be matched by the upsert, so their
    bucket does not matter for correctness. Hashing the key alone would put all
    of them into one bucket (a hot group); they are spread over the buckets by
    hashing ``spread`` (for instance the whole row) instead.
    """
    cols = [_col(k) for k in keys]
    by_key = F.pmod(F.xxhash64(*cols), F.lit(buckets))
    if not spread:
        return by_key.cast("int")
    by_row = F.pmod(F.xxhash64(*[_col(c) for c in spread]), F.lit(buckets))
    return F.when(any_null(cols), by_row).otherwise(by_key).cast("int")


def range_bucket(
    key: ColumnLike, width: int, spread: Sequence[ColumnLike] = (), null_buckets: int = 16
) -> Column:
    """Range bucket of a numeric key: ``floor(key / width)``.

    For keys that grow with time (order numbers), new rows and changes to recent
    rows land in the newest buckets, so an incremental upsert rewrites few
    buckets; the number of buckets grows with the data and each holds at most
    ``width`` keys. Exact for keys below 2**53. Rows with a NULL key (never
    matched) are spread over ``null_buckets`` negative bucket numbers.
    """
    k = _col(key)
    by_range = F.floor(k / F.lit(width)).cast("int")
    if not spread:
        return by_range
    by_row = F.lit(-1) - F.pmod(F.xxhash64(*[_col(c) for c in spread]), F.lit(null_buckets))
    return F.when(k.isNull(), by_row.cast("int")).otherwise(by_range)


def packed_key(key: ColumnLike) -> Column:
    """A text key as bytes for a join: equal where the texts are equal, NULL stays NULL.

    A surrogate id, 64 hex digits that no codec of a shuffle shortens, becomes its 32 bytes.
    Any other text keeps its own bytes and gets 33 more, so it is longer than an id.
    """
    k = _col(key).cast("string")
    raw = F.unhex(k)
    is_id = (F.octet_length(k) == 64) & (F.lower(F.hex(raw)) == k)
    return F.when(is_id, raw).when(
        k.isNotNull(), F.concat(F.encode(k, "UTF-8"), F.lit(bytes(33)))
    )


def unpacked_key(packed: ColumnLike) -> Column:
    """The text that ``packed_key`` made into bytes."""
    p = _col(packed)
    text = F.substr(p, F.lit(1), F.octet_length(p) - 33).cast("string")
    return F.when(F.octet_length(p) == 32, F.lower(F.hex(p))).otherwise(text)


def _with_ids(df: DataFrame, change) -> DataFrame:
    """``df`` with ``change`` applied to its surrogate ids (``id``, ``*_id``, ``*_fk``), in lists of structs too."""

    def is_id(f: T.StructField) -> bool:
        return isinstance(f.dataType, (T.StringType, T.BinaryType)) and (f.name == "id" or f.name.endswith(("_id", "_fk")))

    def items(array: Column, fields: list[T.StructField]) -> Column:
        parts = lambda e: [(change(e[f.name]) if is_id(f) else e[f.name]).alias(f.name) for f in fields]
        return F.transform(array, lambda e: F.when(e.isNotNull(), F.struct(*parts(e))))

    out = []
    for f in df.schema.fields:
        kind = f.dataType
        if is_id(f):
            out.append(change(F.col(f.name)).alias(f.name))
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType) and any(map(is_id, kind.elementType)):
            out.append(items(F.col(f.name), kind.elementType.fields).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def packed_ids(df: DataFrame) -> DataFrame:
    """``df`` with its surrogate ids as ``packed_key``: what a shuffle carries of them is half as long."""
    return _with_ids(df, packed_key)


def unpacked_ids(df: DataFrame) -> DataFrame:
    """What ``packed_ids`` was given."""
    return _with_ids(df, unpacked_key)


def short_key(key: ColumnLike) -> Column:
    """A 128-bit digest of a text key, to look it up by: equal for equal texts, NULL stays NULL.

    Half as long as the surrogate id, itself a digest that is taken for its key.
    """
    return F.unhex(F.md5(_col(key).cast("string")))


def null_safe_join_key(key: ColumnLike, salt: Sequence[ColumnLike]) -> Column:
    """Join key whose NULLs are replaced by distinct values that match nothing.

    Surrogate ids are 64 hex characters, so a value starting with ``~`` can never
    equal one. Without this, every NULL foreign key of a large fact would land in
    the same shuffle partition of a sort-merge join.
    """
    k = _col(key)
    return F.coalesce(
        k, F.concat(F.lit("~"), F.xxhash64(*[_col(c) for c in salt]).cast("string"))
    )


def packed_join_key(packed: ColumnLike, salt: Sequence[ColumnLike]) -> Column:
    """``null_safe_join_key`` of a ``packed_key``: the values in place of NULLs are shorter than any."""
    spread = null_safe_join_key(F.lit(None).cast("string"), salt)
    return F.coalesce(_col(packed), F.encode(spread, "UTF-8"))
