"""Operators on long series: trailing means over rows, backward as-of joins, last rows of each series.

A series (one key) may hold a third of all rows, so none of them sorts a whole series in one task:
ranges of the order are sorted apart and joined by what little passes between them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramoggia.operators.ranking import ordered_rank

#: Rows of a series that are looked at together, and order values of one range.
BLOCK, WIDTH = 8192, 8192


def trailing_mean(df: DataFrame, key: str, order: str, windows: dict[str, int], suffix: str = "_smooth") -> DataFrame:
    """`df` with the mean of each column of `windows` over so many rows up to and including its own.

    `order` tells the rows of a key apart. Null values take a place in the frame but not in the mean;
    a frame without values gives null. Blocks get copies of the rows before them that their frames need.
    """
    reach = max(windows.values()) - 1
    block = max(BLOCK, reach + 1)
    ranked = ordered_rank(df, [key], order, WIDTH, "_rn")
    own = F.floor(F.col("_rn") / block)
    also = F.when(F.col("_rn") % block >= block - reach, own + 1)
    spread = ranked.withColumn("_block", F.explode(F.filter(F.array(own, also), lambda b: b.isNotNull())))
    for column, n in windows.items():
        frame = Window.partitionBy(key, "_block").orderBy("_rn").rowsBetween(-(n - 1), 0)
        spread = spread.withColumn(column + suffix, F.avg(column).over(frame))
    return spread.where(F.col("_block") == own).drop("_rn", "_block")


def asof_backward(left: DataFrame, right: DataFrame, key: str, order: str, values: Sequence[str], width: int = WIDTH) -> DataFrame:
    """Each row of `left` (key, order, …) with `values` of the last row of `right` of its key at or before it, else nulls.

    `order` is a whole number; of right rows at one place the greatest by values counts. Keys and orders must not be null.
    """
    bucket = F.floor(F.col(order) / width)
    found = F.struct(F.col(order).alias("_at"), *values)
    rights = right.select(F.col(key), F.col(order), bucket.alias("_bucket"), found.alias("_right"))
    lasts = rights.groupBy(key, "_bucket").agg(F.max("_right").alias("_last"))
    lefts = left.withColumn("_bucket", bucket).withColumn("_row", F.struct(*left.columns))
    marks = lefts.select(key, "_bucket").distinct().withColumn("_last", F.lit(None).cast(lasts.schema["_last"].dataType))
    # One row for a range, however long the series.
    carried = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = lasts.unionByName(marks).groupBy(key, "_bucket").agg(F.max("_last").alias("_last")).withColumn("_carry", F.last("_last", ignorenulls=True).over(carried)).drop("_last")
    both = lefts.select(key, order, "_bucket", "_row", F.lit(None).cast(rights.schema["_right"].dataType).alias("_right"), F.lit(1).alias("_side"))
    both = both.unionByName(rights.withColumns({"_row": F.lit(None).cast(lefts.schema["_row"].dataType), "_side": F.lit(0)}))
    here = Window.partitionBy(key, "_bucket").orderBy(order, "_side", "_right").rowsBetween(Window.unboundedPreceding, 0)
    matched = both.withColumn("_here", F.last("_right", ignorenulls=True).over(here)).where("_side = 1").join(carry, [key, "_bucket"], "left")
    hit = F.coalesce("_here", "_carry")
    return matched.select("_row.*", *[hit[v].alias(v) for v in values])


def last_rows(df: DataFrame, key: str, order: str, n: int, ties: Sequence[str] = (), name: str = "back") -> DataFrame:
    """The last `n` rows of each key, with their place from the end (0 the last)."""
    ranked = ordered_rank(df, [key], order, WIDTH, "_rn", ties)
    sizes = df.groupBy(key).agg(F.count("*").alias("_n")).withColumnRenamed(key, "_k")
    return ranked.join(sizes, F.col(key).eqNullSafe(F.col("_k"))).withColumn(name, F.col("_n") - 1 - F.col("_rn")).where(F.col(name) < n).drop("_k", "_n", "_rn")
