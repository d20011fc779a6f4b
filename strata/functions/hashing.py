"""Change hashes and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions._col import as_col

NULL_TOKEN = "<null>"


def row_hash(cols, sep: str = "||") -> Column:
    """NULL-safe SHA-256 hex over ``cols`` (a NULL is not an empty
    string, so ``(NULL, 'a')`` and ``('', 'a')`` hash differently). Characters
    of the separator inside a value are escaped, so different rows have
    different texts; other values stand as they are."""
    def part(c) -> Column:
        v = F.replace(as_col(c).cast("string"), F.lit("\\"), F.lit("\\\\"))
        for ch in dict.fromkeys(sep):
            v = F.replace(v, F.lit(ch), F.lit("\\" + ch))
        return F.when(v.isNull(), NULL_TOKEN).when(v == NULL_TOKEN, "\\" + NULL_TOKEN).otherwise(v)

    return F.sha2(F.concat_ws(sep, *[part(c) for c in cols]), 256)


def surrogate_key(cols, bits: int = 64) -> Column:
    """Stable key for a business key (same input, same key, on any
    cluster and any partitioning). NULLs count by position. 64 bits (a long)
    serve up to some 10^8 keys; ``bits=128`` gives 32 hex digits for more."""
    if bits == 64:
        return F.xxhash64(*[x for c in cols for x in (as_col(c).isNull(), as_col(c))])
    if bits != 128:
        raise ValueError("bits is 64 or 128")
    return F.substring(row_hash(cols), 1, 32)
