"""Exact duplicates: the first row of each key, in a stated order, however many rows share a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_key(text: Column) -> Column:
    """The hash by which texts are the same; null counts as empty."""
    return F.sha1(F.coalesce(text, F.lit("")))


def first_by_key(df: DataFrame, key: Column, order: Sequence[str]) -> DataFrame:
    """The rows of `df` that are first of their key in the order of the columns `order`, which tell rows apart.

    Only keys and order columns are shuffled, pre-aggregated to one row a key in each partition, so a
    key that holds a third of all rows costs no more than another; texts move once, in the semi-join.
    Rows equal in key and order all stay.
    """
    keyed = df.withColumn("_key", key)
    first = keyed.groupBy("_key").agg(F.min(F.struct(*order)).alias("_first")).select(*[F.col(f"_first.{c}").alias(f"_o{k}") for k, c in enumerate(order)], F.col("_key").alias("_k"))
    on = F.col("_key") == F.col("_k")
    for k, c in enumerate(order):
        on = on & F.col(c).eqNullSafe(F.col(f"_o{k}"))
    return keyed.join(first, on, "left_semi").drop("_key")


def duplicates(df: DataFrame, key: Column) -> DataFrame:
    """(rows, distinct_texts, duplicate_rows, largest_group) of a table, by key."""
    groups = df.groupBy(key.alias("key")).agg(F.count("*").alias("n"))
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("distinct_texts"), F.coalesce(F.max("n"), F.lit(0)).alias("largest_group"))
    return total.select("rows", "distinct_texts", (F.col("rows") - F.col("distinct_texts")).alias("duplicate_rows"), "largest_group")
