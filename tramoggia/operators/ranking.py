"""Ranks within groups of any size, without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramoggia.operators.joins import BROADCAST_ROWS

#: Rows of a group that one bucket gets on average, and the most buckets of a group (beyond which they grow).
BUCKET_ROWS, MOST_BUCKETS = 5_000, 1 << 20


def seeded(seed: int, *columns: str | Column) -> Column:
    """A 64-bit order value that depends on the seed and the columns only."""
    return F.xxhash64(F.lit(seed), *columns)


def rank_in_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "rank", sizes: DataFrame | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """`df` with the 0-based rank of each row in its group, in a seeded order.

    A group of more than `bucket_rows` rows is spread over buckets by its order columns' hash; the rank is the
    number of rows in earlier buckets plus the rank in the bucket, so a group that holds a third of
    all rows becomes many small sorts, and all others are sorted as they are. `sizes` (keys, _size) saves counting
    the groups. Null keys form a group; rows equal in all order columns
    get their ranks in any order. The clashing names _bucket, _before and _size must not occur.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_size")) if sizes is None else sizes
    buckets = F.least(F.ceil(F.col("_size") / bucket_rows), F.lit(MOST_BUCKETS))
    large = sizes.where(F.col("_size") > bucket_rows).select(*keys, buckets.alias("_buckets"))
    groups, parts = large.select(F.count("*"), F.coalesce(F.sum("_buckets"), F.lit(0))).first()
    if groups == 0:
        return df.withColumn(name, (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("bigint"))
    dealt = _joined(df, large, keys, groups).withColumn("_bucket", F.pmod(F.xxhash64(F.lit(7), *order), F.coalesce("_buckets", F.lit(1))))
    counts = dealt.where("_buckets is not null").groupBy(*keys, "_bucket").agg(F.count("*").alias("_before"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_before").over(earlier), F.lit(0)))
    joined = _joined(dealt, counts, [*keys, "_bucket"], parts)
    inner = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    rank = F.coalesce("_before", F.lit(0)) + F.row_number().over(inner) - 1
    return joined.withColumn(name, rank.cast("bigint")).drop("_bucket", "_buckets", "_before")


def _joined(df: DataFrame, small: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """`df` with the other columns of `small` (unique keys, `rows` rows at most), nulls where it has no row; null keys match."""
    names = {k: f"_key{i}" for i, k in enumerate(keys)}
    small = small.withColumnsRenamed(names)
    on = None
    for k, n in names.items():
        same = F.col(k).eqNullSafe(F.col(n))
        on = same if on is None else on & same
    return df.join(F.broadcast(small) if rows <= BROADCAST_ROWS else small, on, "left").drop(*names.values())


def ordered_rank(df: DataFrame, keys: Sequence[str], order: str, width: int, name: str = "rank", ties: Sequence[str] = ()) -> DataFrame:
    """`df` with the 0-based rank of each row in its group by the whole-number column `order`, then `ties`.

    Groups are cut into ranges of `width` order values, each sorted by itself; sums of the ranges'
    counts give the ranks, so a long series isn't one task's work. Null orders come first, in a range of their own.
    """
    bucket = F.coalesce(F.floor(F.col(order) / width), F.lit(-(1 << 62)))
    return _ranked(df.withColumn("_bucket", bucket), keys, [F.col(order), *[F.col(t) for t in ties]], name)


def _ranked(spread: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """The rank from the rows in earlier buckets and the rank in the bucket."""
    counts = spread.groupBy(*keys, "_bucket").agg(F.count("*").alias("_before"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_before").over(earlier), F.lit(0)))
    joined = _joined(spread, counts, [*keys, "_bucket"], BROADCAST_ROWS + 1)
    inner = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    return joined.withColumn(name, (F.col("_before") + F.row_number().over(inner) - 1).cast("bigint")).drop("_bucket", "_before")
