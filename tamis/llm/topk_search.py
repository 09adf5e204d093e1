"""Exact top-k search by an impact-ordered, score-at-a-time index.

Each block of candidates holds, for every dimension, its postings sorted by descending quantised impact |v| in segments of
equal level. A query merges the segments of all dimensions by descending |q| * level: at each threshold, which falls by FALL,
it reads every segment whose impact exceeds it. Of unit vectors v' and q', the inner product is 1 - |v' - q'|^2 / 2, so each
posting adds (v' - q')^2 to its candidate's accumulator, and |v| * |q| * (1 - accumulator / 2) is at any time an upper bound of
the score that falls as postings are read. A candidate whose bound is below the k-th best of some exact scores is proven out.
The walk ends only when few are left, and exactly these are rescored in integers. Bounds are kept above rounding errors, so
scores of any size that fits a long take the same way.

Each task holds one block of candidates, builds its index once, and streams a group of queries past it; both come by an equi-join
on the task's number. There are as many groups as keep the cluster busy: one, where there are blocks enough.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamis.llm.common import join_small, stash

LEVELS = 24
#: How the impact threshold falls from step to step, and the share of the highest impact below which all that is left is read.
FALL, LAST = 0.5, 0.002
#: Share of the postings before which no proof is tried.
FIRST = 0.25
#: A walk ends when at most this share of a block's candidates, or four times k, may still be among the k best.
FEW = 0.1
#: Tasks for each that can run at a time.
TILES = 4
_BLOCK = "block int, n int, d int, ids binary, cells binary"


def quantise(vectors: DataFrame, id_col: str, vec_col: str, scale: float = 256.0) -> DataFrame:
    """(vec_id, v array<bigint>): floor(scale * x) of each component, x as double; rows that are null or hold null or non-finite components are left out."""
    x = F.col(vec_col).cast("array<double>")
    ok = F.col(vec_col).isNotNull() & F.forall(x, lambda c: F.coalesce((F.abs(c) < float("inf")) & ~F.isnan(c), F.lit(False)))
    return vectors.where(ok & F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("vec_id"), F.transform(x, lambda c: F.floor(c * F.lit(scale))).alias("v"))


def _pack(rows: int):
    """Rows (block, vec_id, v) as blocks of up to `rows` rows, gathered over Arrow batches, the last of a block perhaps smaller."""

    def packed(block: int, some: pd.DataFrame) -> pd.DataFrame:
        d = max(map(len, some["v"]))
        cells = np.zeros((len(some), d), np.int64)
        for k, v in enumerate(some["v"]):
            cells[k, : len(v)] = v
        return pd.DataFrame({"block": [block], "n": [len(some)], "d": [d], "ids": [some["vec_id"].to_numpy(np.int64).tobytes()], "cells": [cells.tobytes()]})

    def pack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[int, list[pd.DataFrame]] = {}
        for pdf in parts:
            for block, own in pdf.groupby("block"):
                kept = waiting.setdefault(block, [])
                kept.append(own)
                if sum(map(len, kept)) >= rows:
                    whole = pd.concat(waiting.pop(block))
                    for at in range(0, len(whole), rows):
                        yield packed(block, whole.iloc[at : at + rows])
        for block, kept in waiting.items():
            yield packed(block, pd.concat(kept))

    return pack


class ImpactIndex:
    """Postings of one block of candidates: ids (n), cells (n x d, integers). read counts the postings that searches added up, rescored the components of rows that were scored exactly."""

    def __init__(self, ids: np.ndarray, cells: np.ndarray):
        self.ids, self.cells, self.read, self.rescored = ids, cells, 0, 0
        self.n, self.d = cells.shape
        floats = cells.astype(np.float64)
        self.norm = np.sqrt(np.einsum("ij,ij->i", floats, floats))
        self.step = max(1, math.ceil((int(np.abs(cells).max(initial=0)) + 1) / LEVELS))
        level = (np.abs(cells) // self.step).astype(np.int8)
        self.order = np.argsort(-level, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(floats.T / np.maximum(self.norm, 1e-300), self.order, axis=1)
        # ends[j, l]: postings of dimension j with a level above l, that is, the end of its segments above l
        self.ends = np.stack([np.searchsorted(-level[o, j], -np.arange(LEVELS + 1), side="left") for j, o in enumerate(self.order)]) if self.d else np.zeros((0, LEVELS + 1), int)

    def exact(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        self.rescored += len(rows) * self.d
        return self.cells[rows] @ q

    def search(self, own: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best (scores, ids) by score, then smaller id, without the id `own`; all, if fewer."""
        q = np.concatenate([q, np.zeros(max(0, self.d - len(q)), np.int64)])[: self.d]
        qf = q.astype(np.float64)
        weight, length = np.abs(qf), float(np.linalg.norm(qf))
        unit = qf / max(length, 1e-300)
        alive = self.ids != own
        t = best = weight.max(initial=0) * LEVELS * self.step
        acc, at, floor = np.zeros(self.n), np.zeros(self.d, int), -math.inf
        while t > best * LAST and np.count_nonzero(alive) > max(4 * k, FEW * self.n):
            t *= FALL
            # a segment of level l has values up to (l + 1) * step - 1 and is due once its impact exceeds t
            due = np.clip(np.floor(t / np.maximum(weight, 1e-9) / self.step), 0, LEVELS).astype(np.int64) if t > best * LAST else np.full(self.d, -1)
            for j in np.flatnonzero(weight):
                to = self.ends[j, due[j]] if due[j] >= 0 else self.n
                if to > at[j]:
                    gap = self.values[j, at[j] : to] - unit[j]
                    np.add.at(acc, self.order[j, at[j] : to], gap * gap)
                    self.read += int(to - at[j])
                    at[j] = to
            if at.sum() < FIRST * self.n * self.d and t > best * LAST:
                continue
            some = np.flatnonzero(alive)
            if len(some) < k:
                break
            bound = self.norm * length * (1 - acc / 2 + (self.d + 8) * 2.0**-50)
            if len(some) > 4 * k:
                some = some[np.argpartition(-bound[some], 4 * k)[: 4 * k]]
            # the k-th best of some exact scores is a bound that the k-th best of all reaches
            floor = max(floor, float(np.sort(self.exact(some, q))[-k]))
            alive &= bound >= floor - abs(floor) * 2.0**-50
        rows = np.flatnonzero(alive)
        scores, ids = self.exact(rows, q), self.ids[rows]
        top = np.lexsort((ids, -scores))[:k]
        return scores[top], ids[top]


def _meet(k: int):
    """Rows sorted by (part, role): the block of candidates (role 0), of which an index is made once, then blocks of queries."""

    def meet(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        indexes: dict[int, list[ImpactIndex]] = {}
        for pdf in parts:
            for r in pdf.itertuples(index=False):
                ids, cells = np.frombuffer(r.ids, np.int64), np.frombuffer(r.cells, np.int64).reshape(r.n, r.d)
                if r.role == 0:
                    indexes = {r.part: [*indexes.get(r.part, []), ImpactIndex(ids, cells)]}
                    continue
                for index in indexes.get(r.part, []):
                    found = [index.search(a, q, k) for a, q in zip(ids, cells, strict=True)]
                    size = [len(s) for s, _ in found]
                    yield pd.DataFrame({"query_id": np.repeat(ids, size), "vec_id": np.concatenate([i for _, i in found] or [[]]).astype(np.int64), "score": np.concatenate([s for s, _ in found] or [[]]).astype(np.int64)})

    return meet


def task_keys(spark: SparkSession, n: int) -> DataFrame:
    """(part, key) for part in 0 to n - 1: keys that repartition(n, key) sends to the partition of that number, so that no two tasks' rows meet in one."""
    tried = spark.range(max(64, 24 * n)).select(F.col("id").alias("key"), F.pmod(F.hash("id"), F.lit(n)).alias("part"))
    return tried.groupBy("part").agg(F.min("key").alias("key"))


def topk_search(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 256.0, block_rows: int = 8192, query_rows: int = 512) -> DataFrame:
    """The k candidates of `vectors` with the highest integer inner product for every row of `queries`: query_id, rank (from 1), vec_id, score.

    Ties go to the smaller id. Rows bearing the query's id are its own and are no candidates; a query id that occurs more than
    once is answered once, for its smallest vector. Vectors that are null or hold null or non-finite components take no part;
    shorter vectors are read as if padded with zeros. Repeated candidate rows each count. Fewer candidates than k: all of
    them; empty tables: no rows. Other columns of the inputs are ignored. Scores are exact as long as they fit a long.
    """
    spark = vectors.sparkSession
    cand, ask = quantise(vectors, id_col, vec_col, scale), quantise(queries, id_col, vec_col, scale).groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = max(1, math.ceil(cand.count() / block_rows))
    groups = max(1, min(math.ceil(ask.count() / query_rows), math.ceil(TILES * spark.sparkContext.defaultParallelism / blocks)))
    deal = lambda df, n: df.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")).repartition(n, "block")
    index = stash(deal(cand, blocks).mapInPandas(_pack(2 * block_rows), _BLOCK), "impact-blocks")
    asked = stash(deal(ask, groups).mapInPandas(_pack(query_rows), _BLOCK), "impact-queries")
    # task `part` has block part // groups of the candidates and group part % groups of the queries
    rows = ("n", "d", "ids", "cells")
    first = index.select(F.explode(F.sequence(F.col("block") * groups, F.col("block") * groups + (groups - 1))).alias("part"), F.lit(0).alias("role"), *rows)
    then = asked.select(F.explode(F.sequence(F.col("block"), F.lit((blocks - 1) * groups) + F.col("block"), F.lit(groups))).alias("part"), F.lit(1).alias("role"), *rows)
    keys = stash(task_keys(spark, blocks * groups), "task-keys")
    met = join_small(first.unionByName(then), keys, ["part"], F.col("part")).withColumn("key", F.coalesce("key", F.col("part")))
    met = met.repartition(blocks * groups, "key").sortWithinPartitions("part", "role").select("part", "role", *rows)
    found = met.mapInPandas(_meet(k), "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
