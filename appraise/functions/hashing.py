"""Repeatable randomness.

Every "random" step of the library (donor draws, splits, folds, bootstrap draws,
column shuffles, random categories) is a keyed hash of a salt and a unique row id:

    h(salt, id) = first 15 hex digits of md5(salt || ':' || id), read as an integer in [0, 2^60)

It is a pure column expression, so it is evaluated inside whole-stage codegen, gives
the same value on every run, on any partitioning, after an executor is lost and the
task re-runs, and in any SQL engine with md5 (that is how the DuckDB oracles check it). 60 bits
reach every slot of a draw ``h mod n`` for any table size, with a modulo bias below n / 2^60.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60
HASH_SPACE = 1 << HASH_BITS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def keyed_hash(salt, id_col) -> Column:
    """BIGINT in [0, 2^60). ``salt`` is a python string or a string Column."""
    salt_col = F.lit(salt) if isinstance(salt, str) else salt
    text = F.concat(salt_col, F.lit(":"), _col(id_col).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def keyed_uniform(salt, id_col) -> Column:
    """A repeatable draw in (0, 1): (top 52 bits of h + 0.5) / 2^52, exact in a double."""
    return (F.shiftright(keyed_hash(salt, id_col), HASH_BITS - 52) + F.lit(0.5)) / F.lit(float(1 << 52))
