"""Row fingerprints, surrogate keys, unknown members and null-tolerant comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "all_equal", "any_differs", "blank_unless", "differs_by_sentinel", "fingerprint", "hash_key",
    "mixed_hash_key", "unknown_member",
]


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def fingerprint(cols: Sequence[Column | str], upper: bool = False, sep: str = "") -> Column:
    """md5 over the columns as text, NULL counting as ''.

    With the default empty separator ('ab','c') and ('a','bc') share a fingerprint; that is the
    stored meaning of existing hashes. Pass ``sep`` for new tables.
    """
    text = F.concat_ws(sep, *[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols])
    return F.md5(F.upper(text) if upper else text)


def hash_key(cols: Sequence[Column | str], unknown: int = -1) -> Column:
    """Non-negative 32-bit hash key; ``unknown`` when every part is NULL.

    The absolute value is taken as a long, so the smallest integer does not overflow. At 2^31
    values collisions are certain on large domains: prefer ``mixed_hash_key`` for new keys.
    """
    cols = [_c(c) for c in cols]
    empty = reduce(lambda a, b: a & b, [c.isNull() for c in cols])
    return F.when(empty, F.lit(unknown).cast("bigint")).otherwise(
        F.abs(F.hash(*cols).cast("bigint"))
    )


def mixed_hash_key(cols: Sequence[Column | str], unknown: int = -1) -> Column:
    """64-bit variant of ``hash_key``, cleared to the positive range."""
    cols = [_c(c) for c in cols]
    empty = reduce(lambda a, b: a & b, [c.isNull() for c in cols])
    return F.when(empty, F.lit(unknown).cast("bigint")).otherwise(
        F.xxhash64(*cols).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF).cast("bigint"))
    )


def unknown_member(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """NULL foreign keys and descriptions become the given member, in the column's own type."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in defaults.items()}
    )


def blank_unless(df: DataFrame, cols: Sequence[str], keep: Column) -> DataFrame:
    """NULL the columns on rows where ``keep`` is not true."""
    return df.withColumns({c: F.when(keep, F.col(c)) for c in cols})


def all_equal(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """Null-safe equality of all pairs; stays a hash-joinable key."""
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in pairs])


def any_differs(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """True when any pair differs, NULL being equal only to NULL."""
    return reduce(lambda a, b: a | b, [~x.eqNullSafe(y) for x, y in pairs])


def differs_by_sentinel(a: Column, b: Column) -> Column:
    """Text inequality in which NULL and '' are the same value."""
    return F.coalesce(a.cast("string"), F.lit("")) != F.coalesce(b.cast("string"), F.lit(""))
