"""Deterministic pseudo-random numbers from row values.

``md5`` gives the same number in any engine; ``xxhash64`` is the fast choice
when only Spark has to agree with itself. Both are non-negative, so they can be
used with remainders and as an order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .predicates import ColumnLike, as_column

#: Significant bits of each hash, needed to cut its range into equal slices.
HASH_BITS = {"md5": 32, "xxhash64": 63}


def stable_hash(*parts: ColumnLike | int, method: str = "md5") -> Column:
    """Hash of the given columns and integer salts as a non-negative bigint."""
    cols = [F.lit(p) if isinstance(p, int) else as_column(p) for p in parts]
    if method == "md5":
        text = F.concat_ws("|", *[c.cast("string") for c in cols])
        number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
        # Never NULL; saying so spares Spark a second hash for a NULL test before joins.
        return F.coalesce(number, F.lit(0).cast("bigint"))
    if method == "xxhash64":
        return F.xxhash64(*cols).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))
    raise ValueError(f"unknown hash method {method!r}")


def hash_mod(n: int, *parts: ColumnLike | int, method: str = "md5") -> Column:
    """Deterministic number in ``0 .. n-1``."""
    return F.pmod(stable_hash(*parts, method=method), F.lit(n))
