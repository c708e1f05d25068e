"""Row hashes that decide samples and splits.

A choice made from the row's own values holds however Spark lays the rows out and
however often a lost task is run again; one drawn per partition does not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 52
HASH_SPACE = 1 << HASH_BITS


def row_hash(keys: list[str], seed: int = 42) -> Column:
    """Hash in [0, 2^52) over the key columns."""
    mixed = F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])
    return F.shiftrightunsigned(mixed, 64 - HASH_BITS)


def portable_hash(keys: list[str], seed: int = 42) -> Column:
    """Same range, from MD5 over integer or text keys: other engines get the same value.

    Slower than :func:`row_hash`; for samples that must be drawn again elsewhere.
    """
    joined = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(joined.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")
