"""Ordinals of rows without a global sort or a window over them: rows are numbered within their part, and shifted by the parts before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.workspace import written

#: monotonically_increasing_id() holds the partition above these bits and the row's place in it below.
_PLACE = 33


def shifted(rows: DataFrame, part: list[str], at: Column, name: str, keep: list[str]) -> DataFrame:
    """rows (a written table) with `name`: the place of a row in its part, plus the rows of the parts before, by `part`. Within a part, `at` ascends by 1. A row a part is all that is ranked and broadcast."""
    sums = rows.groupBy(*part).agg(F.count("*").alias("_n"), F.min(at).alias("_least"))
    before = sums.select(*part, (F.sum("_n").over(Window.orderBy(*part)) - F.col("_n") - F.col("_least")).alias("_shift"))
    return rows.join(F.broadcast(before), part).select(*(f"`{c}`" for c in keep), (at + F.col("_shift")).alias(name))


def with_ordinals(df: DataFrame, name: str = "pos") -> DataFrame:
    """df with `name`: ordinals from 0 in the order of its partitions and of the rows in them, which is the order of an orderBy() before. The rows are written, so that the numbers stay."""
    kept = [c for c in df.columns if c.lower() != name.lower()]
    rows = written(df.select(*(f"`{c}`" for c in kept), F.monotonically_increasing_id().alias("_at")).withColumn("_part", F.shiftright("_at", _PLACE)), "ordinals")
    return shifted(rows, ["_part"], F.col("_at"), name, kept)


def zip_strict(a: DataFrame, b: DataFrame, name: str = "pos") -> DataFrame:
    """The rows of two tables side by side, the first with the first, with their ordinal `name`; an error if one has more rows than the other. Names of columns must differ."""
    both = {c.lower() for c in a.columns} & {c.lower() for c in b.columns}
    if both:
        raise ValueError(f"both tables have the columns {sorted(both)}")
    left, right = with_ordinals(a, name), with_ordinals(b, name)
    n, m = left.count(), right.count()
    if n != m:
        raise ValueError(f"{n} rows cannot be zipped with {m}")
    return left.join(right, name)
