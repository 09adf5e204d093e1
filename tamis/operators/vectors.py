"""Nearest vectors by cosine distance: blocks of vectors, what of them is nearest to a block of queries, and where they meet.

A small store is held by every task, so that queries stay where they are and each is answered in one place. A larger one is cut
into blocks; tiles of (block, group of queries) are tasks, as many as keep the cluster busy and no more than blocks ask for. A
task holds one block and streams its queries past it. No pair of query and vector becomes a row, and no tile shares a task with
another because their numbers collide.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A store up to this size is held by every task.
HELD_BYTES = 16 << 20
BLOCK_ROWS, QUERY_ROWS = 8192, 4096
#: Tiles for each task that can run at a time.
TILES = 4
PACKED = "n int, ids binary, x binary"
FOUND = "query_id bigint, id bigint, distance double"


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; rows of zeros stay."""
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


def nearest(ids: np.ndarray, x: np.ndarray, q_ids: np.ndarray, q: np.ndarray, k: int, exclude_self: bool = False) -> pd.DataFrame:
    """(query_id, rank, id, distance): for each query the k nearest of unit vectors x, whose ids ascend, ties by id. Distances are rounded to 12 digits, so that rounding decides nothing."""
    out = []
    for at in range(0, len(q), 512):
        d, own = np.round(1 - q[at : at + 512] @ x.T, 12) + 0.0, q_ids[at : at + 512]
        if exclude_self:
            d[own[:, None] == ids[None, :]] = np.inf
        m = min(k, len(ids))
        a, b = np.nonzero((d <= np.partition(d, m - 1, axis=1)[:, m - 1 : m]) & np.isfinite(d))
        order = np.lexsort((b, d[a, b], a))
        a, b = a[order], b[order]
        rank = np.arange(len(a)) - np.searchsorted(a, a) + 1
        a, b, rank = a[rank <= k], b[rank <= k], rank[rank <= k]
        out.append(pd.DataFrame({"query_id": own[a], "rank": rank, "id": ids[b], "distance": d[a, b]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "rank": [], "id": [], "distance": []})


def pack(by: list[str], rows: int):
    """Rows (by, id, embedding) as blocks (by, n, ids, x) of unit vectors by ascending id, gathered over Arrow batches until there are `rows` of them."""

    def block(key: tuple, some: list[pd.DataFrame]) -> pd.DataFrame:
        whole = pd.concat(some).sort_values("id", kind="stable")
        cells = {"n": [len(whole)], "ids": [whole["id"].to_numpy(np.int64).tobytes()], "x": [unit(matrix(whole["embedding"])).tobytes()]}
        return pd.DataFrame(dict(zip(by, ([v] for v in key), strict=True)) | cells)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[tuple, list[pd.DataFrame]] = {}
        for pdf in parts:
            for key, own in pdf.groupby(by):
                kept = waiting.setdefault(key, [])
                kept.append(own)
                if sum(map(len, kept)) >= rows:
                    yield block(key, waiting.pop(key))
        for key, kept in waiting.items():
            yield block(key, kept)

    return run


def unpack(r) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(r.ids, np.int64), np.frombuffer(r.x).reshape(r.n, -1)


def meet(by: list[str], k: int, exclude_self: bool = False):
    """Rows (by, role, n, ids, x) sorted by (by, role): blocks of the store (role 0), then blocks of queries (role 1)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held = None, []
        for pdf in parts:
            for r in pdf.itertuples(index=False):
                key = tuple(getattr(r, c) for c in by)
                if key != at:
                    at, held = key, []
                if r.role == 0:
                    held.append(unpack(r))
                    continue
                q_ids, q = unpack(r)
                for ids, x in held:
                    yield nearest(ids, x, q_ids, q, k, exclude_self)[["query_id", "id", "distance"]]

    return run


def task_keys(spark: SparkSession, n: int) -> DataFrame:
    """(part, key) for part in 0 to n - 1: repartition(n, key) sends a key to the partition of its part, so that no two parts meet in one."""
    tried = spark.range(max(64, 24 * n)).select(F.col("id").alias("key"), F.pmod(F.hash("id"), F.lit(n)).alias("part"))
    return tried.groupBy("part").agg(F.min("key").alias("key"))


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of all that was found for a query."""
    order = Window.partitionBy("query_id").orderBy("distance", "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "distance")


def top_k(queries: DataFrame, passages: DataFrame, k: int = 3, exclude_self: bool = False, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS, held_bytes: int | None = None) -> DataFrame:
    """(query_id, rank, id, distance): the k passages (id bigint, embedding) with the smallest cosine distance to each query (query_id bigint, embedding), ties by id; fewer if the store is small. exclude_self leaves out the passage whose id is the query's. Vectors of zeros are at distance 1. Query ids are unique."""
    spark = queries.sparkSession
    store, asked = passages.select("id", "embedding"), queries.select("query_id", "embedding")
    n, d = store.agg(F.count("*"), F.max(F.size("embedding"))).first()
    if n * (d or 0) * 8 <= (HELD_BYTES if held_bytes is None else held_bytes):
        return _held(asked, store, k, exclude_self)
    blocks = math.ceil(n / block_rows)
    groups = max(1, min(math.ceil(asked.count() / query_rows), math.ceil(TILES * spark.sparkContext.defaultParallelism / blocks)))
    deal = lambda df, n, rows: df.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")).repartition(n, "block").mapInPandas(pack(["block"], rows), f"block bigint, {PACKED}")
    held = deal(store, blocks, 2 * block_rows).select(F.explode(F.sequence(F.col("block") * groups, F.col("block") * groups + (groups - 1))).alias("part"), F.lit(0).alias("role"), "n", "ids", "x")
    asking = deal(asked.withColumnRenamed("query_id", "id"), groups, query_rows).select(F.explode(F.sequence(F.col("block"), F.lit((blocks - 1) * groups) + F.col("block"), F.lit(groups).cast("bigint"))).alias("part"), F.lit(1).alias("role"), "n", "ids", "x")
    # a key a tile, a few bytes each
    met = held.unionByName(asking).join(F.broadcast(task_keys(spark, blocks * groups)), "part", "left").withColumn("key", F.coalesce("key", "part"))
    met = met.repartition(blocks * groups, "key").sortWithinPartitions("part", "role").select("part", "role", "n", "ids", "x")
    return ranked(met.mapInPandas(meet(["part"], k, exclude_self), FOUND), k)


def _held(asked: DataFrame, store: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    """Queries against a store that every task holds; they are not shuffled."""
    rows = sorted(((r["id"], r["embedding"]) for r in store.collect()), key=lambda r: r[0])
    ids = np.array([i for i, _ in rows], np.int64)
    sent = asked.sparkSession.sparkContext.broadcast((ids, unit(np.array([v for _, v in rows], np.float64)) if rows else np.zeros((0, 0))))

    def answer(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, x = sent.value
        for pdf in parts:
            if len(pdf) and len(ids):
                yield nearest(ids, x, pdf["query_id"].to_numpy(np.int64), unit(matrix(pdf["embedding"])), k, exclude_self)

    return asked.mapInPandas(answer, "query_id bigint, rank int, id bigint, distance double")
