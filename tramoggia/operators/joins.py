"""Joins against a lookup table whose size is checked before it is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows up to which a lookup of narrow rows is sent to all executors.
BROADCAST_ROWS = 200_000
#: Copies of a larger lookup, over which the rows of a hot key are spread.
SALT = 16


def lookup(df: DataFrame, small: DataFrame, key: str, how: str = "left", limit: int = BROADCAST_ROWS) -> DataFrame:
    """`df` joined with `small` (unique `key`): by broadcast if it has at most `limit` rows, else salted.

    Beyond the limit every row of `small` is copied SALT times and the rows of `df` are dealt to the
    copies, so a key that holds a third of all rows isn't one task's work. The copies are merged: the planner takes them
    for as small as the one compressed table, and would broadcast them all. Null keys match nothing.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(how)
    if small.count() <= limit:
        return df.join(F.broadcast(small), key, how)
    salts = F.explode(F.array([F.lit(k) for k in range(SALT)]))
    salted = small.withColumn("_salt", salts)
    dealt = df.withColumn("_salt", F.pmod(F.xxhash64(*[c for c, t in df.dtypes if not t.startswith(("map", "variant"))]), F.lit(SALT)).cast("int"))
    return dealt.join(salted.hint("merge"), [key, "_salt"], how).drop("_salt")
