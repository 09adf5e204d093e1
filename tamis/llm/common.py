"""What several operators share: written tables in the shared folder, joins that check sizes, connected components."""

from __future__ import annotations

import atexit
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType, StructType

from tamis.workspace import shared_dir

#: A side is broadcast only if its measured size is below this.
BROADCAST_BYTES = 32 << 20


def unused(taken: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to clash with none that is taken."""
    low, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in low:
            name = "_" + name
        low.add(name.lower())
        out.append(name)
    return out


def cols(names: list[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in names]


_stashed: dict[str, SparkSession] = {}


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: a cut in the lineage that survives lost executors. Tables that no drop() has deleted go when the program ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _stashed[path] = spark
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tamis_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete stashed tables that nothing reads any more."""
    for df in tables:
        path = getattr(df, "_tamis_path", None)
        if path and _stashed.pop(path, None):
            _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _sweep() -> None:
    for path, spark in _stashed.items():
        try:
            _delete(spark, path)
        except Exception:  # the session has ended before
            return


def bytes_of(df: DataFrame) -> int:
    """What the rows of a written table take in a broadcast: 48 bytes a row, 8 a column, and the contents of strings, binaries and arrays."""
    size = F.lit(48 + 8 * len(df.columns)).cast("bigint")
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, StringType | BinaryType):
            size += F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(field.dataType, ArrayType):
            inner = field.dataType.elementType
            if isinstance(inner, StringType | BinaryType):
                raise ValueError("arrays of strings are not measured")
            size += F.greatest(F.size(c), F.lit(0)) * (16 + 8 * len(inner) if isinstance(inner, StructType) else 8)
    return df.agg(F.sum(size)).first()[0] or 0


def join_small(big: DataFrame, small: DataFrame, on: list[str], salt_by: Column, how: str = "left", salts: int = 32) -> DataFrame:
    """Join a table with a stashed one that is usually small: broadcast if its measured size is within BROADCAST_BYTES, else a shuffle join whose keys are salted, so that a hot key is spread over `salts` tasks."""
    if bytes_of(small) <= BROADCAST_BYTES:
        return big.join(F.broadcast(small), on, how)
    if salts == 1:  # no key of big is hot
        return big.join(small, on, how)
    (salt,) = unused([*big.columns, *small.columns], "_salt")
    left = big.withColumn(salt, F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int"))
    right = small.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, salt], how).drop(salt)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): one row (node, component_id) for every node that has a link to another; component_id is the smallest node. Alternating large and small stars; hubs are met by grouped minima and joins, never gathered in a task."""
    e = stash(edges.select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).where("u > v").distinct(), "edges")
    before = None
    while True:  # each round shortens paths, so it ends after about log2 of the longest
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(low, "u")
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(near.select("u", F.col("m").alias("v"))).where("u > v").distinct()
        after = stash(small, "edges")
        sign = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop(e)
        e = after
        if sign == before:
            break
        before = sign
    out = e.select(F.col("u").alias("node"), F.col("v").alias("component_id")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component_id"))).distinct()
    out._tamis_path = e._tamis_path
    return out


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each of n positions over the links a-b, within one task."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root
