"""Centroid clustering by Yinyang grouping.

Centroids are put into groups once. Every vector keeps an upper bound of the distance to its own centroid, and for each group a
lower bound of the distance to the group's others. Centroids move between rounds; bounds follow them by the triangle
inequality. A vector whose upper bound is below all its lower bounds keeps its centroid (global filter); else a group whose
bound is not reached is passed over (group filter); of the groups that remain every centroid that its own drift lets come near
is measured. Distances are exact integers; bounds are floats that are kept apart by more than their rounding, so a tie is never
filtered.

A round is one pass without a shuffle: each task reads its rows and their bounds, and writes them again with what the vectors
that changed centroid add and take away; these sums, a row a centroid and task, are added up and are all that the driver gets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import drop, stash

#: Centroids of a group, about.
GROUP = 4
#: Rows whose distances a task computes at a time.
ROWS = 4096
_STATE = "vec_id string, v binary, cluster int, upper double, lower binary, distance bigint, n bigint, sums array<bigint>, scanned bigint"


def to_integers(vectors: DataFrame, id_col: str, vec_col: str, dimensions: int, scale: float) -> DataFrame:
    """(vec_id, as text, and v array<bigint>): floor(scale * x) of each component, x as double, of the vectors with that many components, none null or non-finite."""
    x = F.col(f"`{vec_col}`").cast("array<double>")
    ok = x.isNotNull() & (F.size(x) == dimensions) & F.forall(x, lambda c: F.coalesce((F.abs(c) < float("inf")) & ~F.isnan(c), F.lit(False)))
    return vectors.where(ok).select(F.col(f"`{id_col}`").cast("bigint").cast("string").alias("vec_id"), F.transform(x, lambda c: F.floor(c * F.lit(scale))).alias("v"))


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x and c, exact: in floats where they hold every step, else in integers."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * x.shape[1] * most * most < 1 << 53:
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(1) for row in c], axis=1)


def _low(d: np.ndarray) -> np.ndarray:
    """The root, and a little less, so that it bounds from below."""
    return np.sqrt(d.astype(np.float64)) * (1 - 1e-12)


def _high(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(np.float64)) * (1 + 1e-12)


def group_centroids(centroids: np.ndarray, size: int = GROUP) -> np.ndarray:
    """The group of each centroid: a few rounds of clustering them among themselves."""
    groups = max(1, math.ceil(len(centroids) / size))
    centers, own = centroids[np.linspace(0, len(centroids) - 1, groups).astype(int)].astype(float), np.zeros(len(centroids), int)
    for _ in range(5):
        own = ((centroids[:, None, :] - centers[None, :, :]) ** 2).sum(2).argmin(1)
        centers = np.stack([centroids[own == g].mean(0) if (own == g).any() else centers[g] for g in range(groups)])
    return np.unique(own, return_inverse=True)[1]


class Yinyang:
    """One round over blocks of vectors. before: the centroids that the bounds refer to, None in the first round. scanned counts the distances computed."""

    def __init__(self, centroids: np.ndarray, groups: np.ndarray, before: np.ndarray | None):
        self.c, self.groups, self.t, self.scanned = centroids, groups, int(groups.max()) + 1, 0
        drift = np.zeros(len(centroids)) if before is None else _high(((centroids - before) ** 2).sum(1))
        self.drift, self.members = drift, [np.flatnonzero(groups == g) for g in range(self.t)]
        self.most = np.array([drift[m].max() for m in self.members])

    def first(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(own, upper, lower) of vectors without bounds: every centroid is measured."""
        d = squared(x, self.c)
        self.scanned += d.size
        own = d.argmin(1)
        at = np.arange(len(x))
        upper = _high(d[at, own])
        near = _low(d)
        near[at, own] = np.inf
        return own, upper, np.stack([near[:, m].min(1) for m in self.members], axis=1)

    def next(self, x: np.ndarray, own: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same after the centroids have moved."""
        old, was, best = lower, own, own.copy()
        upper, lower = (upper + self.drift[own]) * (1 + 1e-12), (lower - self.most) * (1 - 1e-12) - 1e-9
        near = np.flatnonzero(upper >= lower.min(1))
        least = np.zeros(len(x), np.int64)
        least[near] = self.to_own(x[near], own[near])
        upper[near] = _high(least[near])
        near = near[upper[near] >= lower[near].min(1)]
        to_was = _low(least)
        for g, members in enumerate(self.members):
            rows = near[upper[near] >= lower[near, g]]
            # an own centroid that has lost to one of another group is one of the others now
            lower[rows, g] = np.where((best[rows] != was[rows]) & (self.groups[was[rows]] == g), to_was[rows], np.inf)
            for j in members if len(rows) else ():
                others = rows[was[rows] != j]
                bound = (old[others, g] - self.drift[j]) * (1 - 1e-12) - 1e-9
                open_ = upper[others] >= bound
                rest, some = others[~open_], others[open_]
                lower[rest, g] = np.minimum(lower[rest, g], bound[~open_])
                d = squared(x[some], self.c[j : j + 1])[:, 0]
                self.scanned += len(some)
                better = (d < least[some]) | ((d == least[some]) & (j < best[some]))
                win, lose = some[better], some[~better]
                lower[lose, g] = np.minimum(lower[lose, g], _low(d[~better]))
                beaten = self.groups[best[win]]
                lower[win, beaten] = np.minimum(lower[win, beaten], _low(least[win]))
                best[win], least[win] = j, d[better]
                upper[win] = _high(least[win])
        return best, upper, lower

    def to_own(self, x: np.ndarray, own: np.ndarray) -> np.ndarray:
        self.scanned += len(x)
        return ((x - self.c[own]) ** 2).sum(1)


def _matrix(cells: list[bytes], d: int) -> np.ndarray:
    """Rows that were packed as 4 or 8 bytes a component."""
    if len({len(b) for b in cells}) == 1:
        return np.frombuffer(b"".join(cells), np.int32 if len(cells[0]) == 4 * d else np.int64).reshape(-1, d).astype(np.int64)
    return np.stack([np.frombuffer(b, np.int32 if len(b) == 4 * d else np.int64).astype(np.int64) for b in cells])


def _packed(x: np.ndarray) -> list[bytes]:
    fits = np.abs(x).max(initial=0) < 1 << 31
    return [row.tobytes() for row in (x.astype(np.int32) if fits else x)]


def _round(centroids: np.ndarray, groups: np.ndarray, before: np.ndarray | None, last: bool):
    """Rows with their bounds, and a row for each centroid whose sum this task changes."""
    k, d = centroids.shape

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        work, sums, n = Yinyang(centroids, groups, before), np.zeros((k, d), np.int64), np.zeros(k, np.int64)
        for whole in parts:
            for a in range(0, len(whole), ROWS):
                pdf = whole.iloc[a : a + ROWS]
                if before is None:
                    x = np.stack(pdf["v"].to_list()).astype(np.int64)
                    own, upper, lower = work.first(x)
                    cells, moved = _packed(x), np.ones(len(x), bool)
                else:
                    cells, was = pdf["v"].to_list(), pdf["cluster"].to_numpy(np.int64)
                    x = _matrix(cells, d)
                    own, upper, lower = work.next(x, was, pdf["upper"].to_numpy(float), np.frombuffer(b"".join(pdf["lower"]), float).reshape(-1, work.t).copy())
                    moved = own != was
                    np.subtract.at(sums, was[moved], x[moved])
                    np.subtract.at(n, was[moved], 1)
                np.add.at(sums, own[moved], x[moved])
                np.add.at(n, own[moved], 1)
                distance = pd.array(work.to_own(x, own), dtype="Int64") if last else None
                yield pd.DataFrame({"vec_id": pdf["vec_id"], "v": cells, "cluster": own, "upper": upper, "lower": [row.tobytes() for row in lower], "distance": distance, "n": None, "sums": None, "scanned": None})
        changed = np.flatnonzero(n.astype(bool) | sums.any(1))
        yield pd.DataFrame({"vec_id": None, "v": None, "cluster": [*changed, -1], "upper": None, "lower": None, "distance": None, "n": [*n[changed], 0], "sums": [*sums[changed], []], "scanned": [0] * len(changed) + [work.scanned]})

    return run


def _add_up(state: DataFrame, sums: np.ndarray, n: np.ndarray) -> int:
    """Adds what the tasks of a round report, a row a centroid and component, to sums (of Python integers) and n; the distances that they computed."""
    told = state.where("n IS NOT NULL")
    for r in told.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("scanned").alias("scanned")).collect():
        if r["cluster"] < 0:
            scanned = int(r["scanned"])
        else:
            n[r["cluster"]] += r["n"]
    cells = told.select("cluster", F.posexplode("sums").alias("at", "x")).groupBy("cluster", "at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    for r in cells.collect():
        sums[r["cluster"], r["at"]] += int(r["x"])
    return scanned


def cluster_vectors(vectors: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1, id_col: str = "vec_id", vec_col: str = "embedding", dimensions: int = 64, scale: float = 64.0, work: list[int] | None = None) -> DataFrame:
    """id_col, cluster, distance, cluster_inertia, inertia and centroid_sha256 of each vector after `rounds` rounds of k-means over integers.

    Vectors are those with `dimensions` components, none null or non-finite, as floor(scale * x) of each. The k with the smallest
    SHA-256 of `seed:id` are the first centroids, numbered in that order (rows of one id by their components, null ids last; all
    vectors, if fewer). A round assigns every vector to the nearest centroid, ties to the smaller number, and moves each centroid
    that has vectors to the floor of their mean; the others stay. Then all are assigned once more. distance is squared;
    cluster_inertia and inertia are its sums over the cluster and over all; centroid_sha256 is of the final centroid's components
    as decimal integers joined by commas. One row per vector taken, repeated rows included; no vectors, no rows. Other columns
    are ignored. Exact for as long as squared distances and sums fit a long. work, if given, gets the distances computed in
    each round.
    """
    spark = vectors.sparkSession
    ints = to_integers(vectors, id_col, vec_col, dimensions, scale)
    order = F.sha2(F.concat(F.lit(f"{seed}:"), "vec_id"), 256)
    starts = ints.withColumn("place", order).orderBy(F.asc_nulls_last("place"), "v").limit(k).collect()
    if not starts:
        return spark.createDataFrame([], f"`{id_col}` bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    centroids = np.array([r["v"] for r in starts], np.int64)
    groups, before = group_centroids(centroids), None
    sums, n = np.zeros(centroids.shape, object), np.zeros(len(centroids), np.int64)
    state = ints
    for at in range(rounds + 1):
        after = stash(state.mapInPandas(_round(centroids, groups, before, last=at == rounds), _STATE), "clusters")
        if at:
            drop(old)
        old, state = after, after.where("n IS NULL")
        scanned = _add_up(after, sums, n)
        if work is not None:
            work.append(scanned)
        if at < rounds:
            before, centroids = centroids, np.array([[s // m for s in row] if m else list(c) for row, m, c in zip(sums, n.tolist(), centroids.tolist(), strict=True)], np.int64)
    inertia = {r["cluster"]: int(r["d"]) for r in state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    digest = lambda row: hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()
    facts = [(c, d, sum(inertia.values()), digest(centroids[c].tolist())) for c, d in inertia.items()]
    known = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # a row a centroid
    return state.join(F.broadcast(known), "cluster").select(F.col("vec_id").cast("bigint").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
