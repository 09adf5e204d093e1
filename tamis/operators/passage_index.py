"""A stored index of passages for nearest-neighbour search: coarse cells, searched exactly by proof, or approximately.

Centers of cells are fitted once, on a bounded sample of the first passages; every passage goes to the cell of its nearest
center, and later ones too. Vectors are stored in blocks, a folder a cell, each with the radius of its vectors about the
center. For unit vectors the cosine distance is half the squared straight one, so a cell's members are at least
(|q - center| - radius)^2 / 2 away from a query. A first round searches the cells that may hold the nearest vectors; its k-th
distance bounds what any other cell must undercut, and a second round searches exactly those that can. Approximate search is
the first round alone.

A large cell has several blocks, and a cell that many queries ask for is met by groups of them, so neither fills a task.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.operators.retrieval import gather_hits, hashed_embedding, new_passages
from tamis.operators.sampling import shuffled_by, take_first
from tamis.operators.vectors import BLOCK_ROWS, FOUND, PACKED, QUERY_ROWS, matrix, meet, pack, ranked, unit, unpack
from tamis.workspace import written

#: Passages that centers are fitted on at most, and cells at most.
SAMPLE_ROWS, MOST_CELLS = 20_000, 1024
#: Cells of the first round of an exact search.
FIRST_PROBES = 4
#: Names of blocks, some 100 bytes each, are broadcast up to so many.
BROADCAST_NAMES = 1 << 18
#: More than rounding can take from a straight distance near 0.
_SLACK = 1e-7


def fit_centers(x: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Centers of unit vectors by a few rounds of clustering, from evenly spaced ones on; empty cells are left out."""
    x = np.unique(x, axis=0)
    centers = x[np.linspace(0, len(x) - 1, min(cells, len(x))).astype(int)]
    for _ in range(rounds):
        own = nearest_center(x, centers)[0]
        n = np.bincount(own, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, own, x)
        centers = (sums / np.maximum(n, 1)[:, None])[n > 0]
    return centers


def straight(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Straight distances of all rows to all centers."""
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] - 2 * x @ centers.T + (centers * centers).sum(1)[None, :], 0))


def nearest_center(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = straight(x, centers)
    own = d.argmin(1)
    return own, d[np.arange(len(x)), own]


class PassageIndex:
    """Passages (id, flag, passage) with embeddings below a folder. embed: Column -> Column makes embeddings of texts."""

    def __init__(self, spark: SparkSession, path: str, embed: Callable[[Column], Column] = hashed_embedding, cells: int | None = None, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS):
        self.spark, self.path, self.embed, self.cells, self.block_rows, self.query_rows = spark, path.rstrip("/"), embed, cells, block_rows, query_rows

    # --- what is stored ---

    def _read(self, name: str, schema: str) -> DataFrame:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        there = at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}") if there else self.spark.createDataFrame([], schema)

    def passages(self) -> DataFrame:
        return self._read("passages", "key bigint, id string, flag string, passage string")

    def _blocks(self) -> DataFrame:
        return self._read("blocks", f"block string, {PACKED}, radius double, cell int")

    def _centers(self) -> np.ndarray | None:
        rows = self._read("centers", "cell int, center array<double>").orderBy("cell").collect()
        return np.array([r["center"] for r in rows]) if rows else None

    def count(self) -> int:
        return self.passages().count()

    # --- adding ---

    def add(self, passages: DataFrame, prefix: str = "") -> int:
        """Add passages (pos, flag, passage) whose id is new; returns how many."""
        new = new_passages(passages, self.passages(), prefix=prefix)
        return self.add_vectors(new.select(F.xxhash64("id").alias("key"), "id", "flag", "passage", self.embed(F.col("passage")).alias("embedding")))

    def fill_once(self, read_seeds: Callable[[], DataFrame | None]) -> int:
        """Add seeds to an empty index; one that holds passages, or missing seeds, change nothing."""
        seeds = read_seeds() if self.count() == 0 else None
        return self.add(seeds) if seeds is not None else 0

    def add_vectors(self, rows: DataFrame) -> int:
        """Add rows (key bigint, id, flag, passage, embedding), all new; returns how many. Passages become visible after their vectors, so a run that ends midway leaves none that a search could not find."""
        new = written(rows.select("key", "id", "flag", "passage", "embedding"), "new-passages")
        n = new.count()
        if not n:
            return 0
        centers = self._centers()
        if centers is None:
            sample = take_first(new.select("key", "embedding"), shuffled_by(1, "key"), SAMPLE_ROWS)
            x = unit(matrix(sample.select("embedding").toPandas()["embedding"]))
            centers = fit_centers(x, self.cells or max(1, min(MOST_CELLS, math.isqrt(n))))
            cells = [(c, v.tolist()) for c, v in enumerate(centers)]
            self.spark.createDataFrame(cells, "cell int, center array<double>").coalesce(1).write.parquet(f"{self.path}/centers")
        sent = self.spark.sparkContext.broadcast(centers)

        def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in parts:
                if len(pdf):
                    yield pd.DataFrame({"id": pdf["key"], "embedding": pdf["embedding"], "cell": nearest_center(unit(matrix(pdf["embedding"])), sent.value)[0].astype(np.int32)})

        placed = written(new.select("key", "embedding").mapInPandas(place, "id bigint, embedding array<double>, cell int"), "placed-passages")
        parts = placed.groupBy("cell").agg(F.ceil(F.count("*") / self.block_rows).cast("int").alias("parts"))
        # a row a cell
        dealt = placed.join(F.broadcast(parts), "cell").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))

        def with_radius(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in blocks:
                radius = [float(straight(unpack(r)[1], sent.value[r.cell : r.cell + 1]).max()) for r in pdf.itertuples(index=False)]
                yield pdf.assign(radius=radius)

        packed = dealt.repartition("cell", "part").mapInPandas(pack(["cell", "part"], 2 * self.block_rows), f"cell int, part int, {PACKED}")
        blocks = packed.mapInPandas(with_radius, f"cell int, part int, {PACKED}, radius double")
        batch = uuid.uuid4().hex
        blocks = blocks.withColumn("block", F.concat_ws("-", F.lit(batch), "cell", "part", F.xxhash64("ids").cast("string"))).drop("part")
        blocks.write.mode("append").partitionBy("cell").parquet(f"{self.path}/blocks")
        new.select("key", "id", "flag", "passage").write.mode("append").parquet(f"{self.path}/passages")
        return n

    # --- searching ---

    def query(self, queries: DataFrame, k: int = 3, probes: int | None = None) -> DataFrame:
        """(query_id, hits) of queries (query_id, text); exact, or of the `probes` likeliest cells."""
        found = self.query_vectors(queries.select("query_id", self.embed(F.col("text")).alias("embedding")), k, probes)
        return gather_hits(found, self.passages().withColumn("id", F.col("key")))

    def query_vectors(self, queries: DataFrame, k: int = 3, probes: int | None = None) -> DataFrame:
        """(query_id, rank, id, distance) of queries (query_id bigint, embedding): the k nearest keys by cosine distance, ties by key. With probes, of that many cells only; without, proven exact."""
        centers = self._centers()
        if centers is None:
            return self.spark.createDataFrame([], "query_id bigint, rank int, id bigint, distance double")
        radius = np.full(len(centers), -np.inf)
        for r in self._blocks().groupBy("cell").agg(F.max("radius").alias("r")).collect():  # a row a cell
            radius[r["cell"]] = r["r"]
        asked = written(queries.select("query_id", "embedding"), "index-queries")
        first = written(ranked(self._search(asked, centers, radius, k, probes or FIRST_PROBES), k), "index-hits")
        if probes:
            return first
        reach = first.where(F.col("rank") == k).select("query_id", F.col("distance").alias("reach"))
        second = self._search(asked.join(reach, "query_id", "left"), centers, radius, k, FIRST_PROBES, beyond=True)
        return ranked(first.select("query_id", "id", "distance").unionByName(second), k)

    def recall(self, queries: DataFrame, k: int, probes: int) -> float:
        """The share of the exact hits of some queries that a search of `probes` cells finds."""
        exact, found = (self.query_vectors(queries, k, p).select("query_id", "id") for p in (None, probes))
        return found.join(exact, ["query_id", "id"], "left_semi").count() / max(1, exact.count())

    def probes_for(self, queries: DataFrame, k: int = 3, recall: float = 0.9) -> int:
        """How many cells a search has to probe for that recall, measured on some queries by doubling."""
        centers, probes = self._centers(), 1
        while probes < len(centers if centers is not None else ()) and self.recall(queries, k, probes) < recall:
            probes *= 2
        return probes

    def _search(self, asked: DataFrame, centers: np.ndarray, radius: np.ndarray, k: int, probes: int, beyond: bool = False) -> DataFrame:
        """What the `probes` cells of the nearest centers hold; or, beyond them, all cells whose bound is within reach (null: all)."""
        sent, known = self.spark.sparkContext.broadcast((centers, radius)), np.flatnonzero(np.isfinite(radius))

        def choose(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            centers, radius = sent.value
            for pdf in parts:
                if not len(pdf):
                    continue
                q = unit(matrix(pdf["embedding"]))
                place = np.argsort(np.argsort(straight(q, centers[known]), axis=1, kind="stable"), axis=1, kind="stable")
                if beyond:
                    bound, reach = lower_bounds(q, centers[known], radius[known]), pdf["reach"].fillna(np.inf).to_numpy(float)
                    rows, at = np.nonzero((place >= probes) & (bound <= reach[:, None] + _SLACK))
                else:
                    rows, at = np.nonzero(place < probes)
                yield pd.DataFrame({"cell": known[at].astype(np.int32), "id": pdf["query_id"].to_numpy()[rows], "embedding": pdf["embedding"].to_numpy()[rows]})

        pairs = asked.mapInPandas(choose, "cell int, id bigint, embedding array<double>")
        wanted = written(pairs, "index-probes")
        cells = wanted.groupBy("cell").agg(F.ceil(F.count("*") / self.query_rows).cast("int").alias("groups"))
        numbers = {r["cell"]: r["groups"] for r in cells.collect()}  # a row a cell
        if not numbers:
            return self.spark.createDataFrame([], FOUND)
        groups = F.broadcast(self.spark.createDataFrame(list(numbers.items()), "cell int, groups int"))
        # only the folders of asked cells are read
        store = self._blocks().where(F.col("cell").isin(list(numbers))).join(groups, "cell")
        held = store.select("cell", "block", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"), F.lit(0).alias("role"), "n", "ids", "x")
        dealt = wanted.join(groups, "cell").withColumn("group", F.pmod(F.xxhash64("id"), F.col("groups")).cast("int"))
        asking = dealt.repartition("cell", "group").mapInPandas(pack(["cell", "group"], self.query_rows), f"cell int, group int, {PACKED}")
        names = written(store.select("cell", "block"), "index-names")
        names = F.broadcast(names) if names.count() <= BROADCAST_NAMES else names
        met = held.unionByName(asking.join(names, "cell").select("cell", "block", "group", F.lit(1).alias("role"), "n", "ids", "x"))
        met = met.repartition("block", "group").sortWithinPartitions("block", "group", "role").select("block", "group", "role", "n", "ids", "x")
        return met.mapInPandas(meet(["block", "group"], k), FOUND)


def lower_bounds(q: np.ndarray, centers: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Cosine distances that no member of a cell can be below."""
    gap = np.maximum(straight(q, centers) - radius[None, :] - _SLACK, 0)
    return gap * gap / 2
