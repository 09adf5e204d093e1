"""Deterministic random choice: rows in the order of a hash of seed and id, and exact counts of them without a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shuffled_by(seed: int | str, *ids: str) -> Column:
    """A sort key that shuffles rows the same way every time."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(i).cast("string") for i in ids)))


def take_first(df: DataFrame, key: Column, n: int) -> DataFrame:
    """The n rows with the smallest key (a hex digest); all, if fewer. A histogram over the first three digits, at most 4096 rows, finds the bucket in which the count is reached; only that bucket is ranked."""
    if n <= 0:
        return df.limit(0)
    keyed = df.withColumn("_k", key).withColumn("_b", F.substring("_k", 1, 3))
    below, cut, inside = 0, None, 0
    for b, c in sorted((r["_b"], r["count"]) for r in keyed.groupBy("_b").count().collect()):
        if below + c >= n:
            cut, inside = b, n - below
            break
        below += c
    if cut is None:
        return df
    rank = F.row_number().over(Window.partitionBy("_b").orderBy("_k"))
    last = keyed.where(F.col("_b") == cut).withColumn("_r", rank).where(F.col("_r") <= inside).drop("_r")
    return keyed.where(F.col("_b") < cut).unionByName(last).drop("_k", "_b")


def sample_exactly(df: DataFrame, n: int, seed: int | str, *ids: str) -> DataFrame:
    """A random sample of n rows without replacement; all, if fewer."""
    return take_first(df, shuffled_by(seed, *ids), n)


def nth_per_group(df: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    """The n-th row of each group; groups with fewer rows have none."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("_r", rank).where(F.col("_r") <= n).where(F.col("_r") == n).drop("_r")
