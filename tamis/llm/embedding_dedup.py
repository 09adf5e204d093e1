"""Near-duplicate vectors by randomised-rotation binary codes with stored correction factors.

A vector is normalised, rotated into CODE_BITS dimensions by a seeded random orthonormal map, and kept as the signs o of the
result, packed, with its correction factor f = <o / sqrt(D), rotated>. The rotated vector is also kept in QUERY_BITS bits a
dimension, rounded at random, as bit planes. For a code o and another vector's planes q, <o, q> / (sqrt(D) * f) is an unbiased
estimate of the inner product: a few population counts of packed words. Its error stays below EPS deviations of the code,
sqrt((1 - f^2) / f^2 / (D - 1)), and of the rounding, step / 2 / f; only pairs whose upper bound reaches the threshold are
computed again from the vectors.

Pairs meet in buckets within their label, keyed by signs of further random directions, in as many tables as MISS takes. The
number of bits is the one that costs least by the label's size: none, that is one bucket, up to some ten thousand vectors. Each
table has directions of its own, so that tables are independent at any size. Buckets hold codes only; the vectors of rows that have a candidate are fetched for
the second step. A bucket above CELL_ROWS rows is dealt over cells (i, j) of row groups, so no task holds an unbounded bucket,
and no pairs leave a task: only each row's count of links and the smallest row of its part of the cell.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import components, drop, join_small, local_roots, stash

CODE_BITS = 128
QUERY_BITS = 4
EPS = 5.0
#: Probability that a pair exactly at the threshold shares no table.
MISS = 1e-5
#: Moving a row into a table costs as much as comparing it with so many others.
ROW_COST = 2048
CELL_ROWS = 16384
SEED = 20260101
#: Rows of a block of pairs, whose counts stay within a processor's cache.
_BLOCK, _WIDTH = 32, 4096


@cache
def rotation(d: int, part: int = 0) -> np.ndarray:
    """A seeded random map from d dimensions to max(CODE_BITS, d), with orthonormal columns; each part has its own."""
    rng = np.random.default_rng([SEED, d, part])
    return np.linalg.qr(rng.standard_normal((max(CODE_BITS, d), d)))[0]


@cache
def directions(d: int, n: int) -> np.ndarray:
    """n random directions in d dimensions, orthogonal within each run of d."""
    rng = np.random.default_rng([SEED, d, 1 << 20])
    blocks = [np.linalg.qr(rng.standard_normal((d, d)))[0].T for _ in range(-(-n // d))]
    return np.concatenate(blocks)[:n] if blocks else np.zeros((0, d))


@cache
def layout(rows: int, threshold: float) -> tuple[int, int]:
    """(bits, tables) of a label with so many vectors."""
    agree = 1 - math.acos(threshold) / math.pi
    tables = [1, *(math.ceil(math.log(MISS) / math.log1p(-(agree**b))) for b in range(1, 48))]
    bits = min(range(48), key=lambda b: tables[b] * (rows / 2**b + ROW_COST))
    return bits, tables[bits]


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; by a power of two first, so that huge or tiny components neither overflow nor vanish."""
    unit = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
    return unit / np.linalg.norm(unit, axis=1, keepdims=True)


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of 0 and 1 packed into 64-bit words."""
    short = -bits.shape[-1] % 64
    packed = np.packbits(np.pad(bits.astype(np.uint8), [(0, 0)] * (bits.ndim - 1) + [(0, short)]), axis=-1)
    return np.ascontiguousarray(packed).view(np.uint64)


class Codes:
    """Packed codes of some unit vectors, or those read from rows of a table."""

    def __init__(self, unit: np.ndarray, rng: np.random.Generator, part: int = 0):
        turned = unit @ rotation(unit.shape[1], part).T
        self.dim = turned.shape[1]
        self.factor = np.abs(turned).sum(axis=1) / math.sqrt(self.dim)
        self.code = _words(turned > 0)
        self.low = turned.min(axis=1)
        self.step = np.maximum((turned.max(axis=1) - self.low) / ((1 << QUERY_BITS) - 1), 1e-12)
        level = np.floor((turned - self.low[:, None]) / self.step[:, None] + rng.random(turned.shape))
        level = np.clip(level, 0, (1 << QUERY_BITS) - 1).astype(np.uint8)
        self.planes = np.stack([_words(level >> j & 1) for j in range(QUERY_BITS)], axis=1)

    @classmethod
    def read(cls, rows: pd.DataFrame, dim: int) -> Codes:
        self, n = cls.__new__(cls), len(rows)
        self.dim = max(CODE_BITS, dim)
        self.code = np.frombuffer(b"".join(rows["code"]), np.uint64).reshape(n, -1)
        self.planes = np.frombuffer(b"".join(rows["planes"]), np.uint64).reshape(n, QUERY_BITS, -1)
        self.factor, self.low, self.step = (rows[c].to_numpy(np.float64) for c in ("factor", "low", "step"))
        return self

    def bounds(self, a: slice, b: slice) -> np.ndarray:
        """Upper bounds of the inner products of rows a, by their planes, with rows b, by their codes."""
        code, planes, narrow = self.code[b], self.planes[a], np.float32
        wide = np.uint16 if self.dim << QUERY_BITS < 1 << 16 else np.uint32
        ones = np.zeros((len(planes), len(code)), wide)
        for j in range(QUERY_BITS):
            for w in range(code.shape[1]):
                count = np.bitwise_count(planes[:, j, w, None] & code[None, :, w])
                ones += np.left_shift(count, j, dtype=wide)
        set_, total = np.bitwise_count(code).sum(axis=1), (np.bitwise_count(planes).sum(axis=2) * (1 << np.arange(QUERY_BITS))).sum(axis=1)
        root, low, step, f = math.sqrt(self.dim), self.low[a], self.step[a], self.factor[b]
        out = ones * (2 * step / root).astype(narrow)[:, None]
        out += (low / root).astype(narrow)[:, None] * (2.0 * set_ - self.dim).astype(narrow)
        out -= (step * total / root).astype(narrow)[:, None]
        out += self._slack(a, b).astype(narrow)
        out /= f.astype(narrow)
        return out

    def _slack(self, a: slice, b: slice) -> np.ndarray:
        """EPS deviations of the codes b, and of the coarsest rounding among a."""
        return EPS * np.sqrt(np.maximum(0, 1 - self.factor[b] ** 2) / (self.dim - 1) + self.step[a].max(initial=0) ** 2 / 4) + 1e-5


def estimates(codes: Codes) -> np.ndarray:
    """The unbiased estimates of all inner products, without their slack."""
    all_ = slice(0, len(codes.code))
    return codes.bounds(all_, all_) - codes._slack(all_, all_) / codes.factor


_CODED = "cid bigint, label string, dim int, n bigint, code binary, planes binary, factor float, low float, step float, sign binary"


def _encode(threshold: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Codes, and the packed signs that the tables' keys are made of."""

    def encode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in parts:
            for d, own in whole.groupby(whole["x"].map(len)):
                unit = unit_rows(np.stack(own["x"].to_numpy()).astype(np.float64))
                codes = Codes(unit, np.random.default_rng([SEED, int(own["cid"].iloc[0])]))
                bits = [b * t for b, t in (layout(n, threshold) for n in own["n"].tolist())]
                sign = unit @ directions(d, max(bits)).T > 0
                yield own[["cid", "label", "n"]].assign(
                    dim=np.int32(d), code=[c.tobytes() for c in codes.code], planes=[p.tobytes() for p in codes.planes],
                    factor=codes.factor.astype(np.float32), low=codes.low.astype(np.float32), step=codes.step.astype(np.float32),
                    sign=[np.packbits(s[:b]).tobytes() for s, b in zip(sign, bits, strict=True)],
                )

    return encode


def _keys(signs: list[bytes], bits: int, tables: int) -> np.ndarray:
    """The key of each row in each table."""
    if not bits:
        return np.zeros((len(signs), 1), np.int64)
    s = np.unpackbits(np.frombuffer(b"".join(signs), np.uint8).reshape(len(signs), -1), axis=1)[:, : bits * tables]
    return s.reshape(len(signs), tables, bits).astype(np.int64) @ (1 << np.arange(bits, dtype=np.int64))


def _tabled(threshold: float, whole: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A row for each table of each vector: its bucket, with its codes if whole."""

    def tabled(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for (bits, tables), own in pdf.groupby(pdf["n"].map(lambda n: layout(n, threshold))):
                keys = _keys(own["sign"].tolist(), bits, tables)
                for t in range(tables):
                    out = own if whole else own[["label", "dim"]]
                    yield out.assign(t=np.int32(t), key=keys[:, t])

    return tabled


_BUCKET = ["label", "dim", "t", "key"]
_CELL = [*_BUCKET, "i", "j"]


def _together(frames: list[pd.DataFrame]) -> pd.DataFrame:
    """One frame, without strings in several Arrow chunks, which Spark does not take."""
    out = pd.concat(frames, ignore_index=True)
    return out.assign(label=out["label"].astype(object)) if "label" in out else out


def _by_cell(of: Callable[[pd.DataFrame], pd.DataFrame | None]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Calls of() with each cell of two rows or more; rows come sorted by cell."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[pd.DataFrame] = []

        def cells(pdf: pd.DataFrame, last: bool) -> Iterator[pd.DataFrame]:
            change = np.zeros(len(pdf), bool)
            change[0] = True
            for c in _CELL:
                v = pdf[c].to_numpy()
                change[1:] |= v[1:] != v[:-1]
            start = np.append(np.flatnonzero(change), len(pdf))
            for a, b in zip(start[:-1], start[1:], strict=True):
                if b == len(pdf) and not last:
                    kept.append(pdf.iloc[a:])
                elif b - a > 1:
                    yield pdf.iloc[a:b]

        for pdf in parts:
            # nothing is complete while a batch goes on with the cell that is open
            if kept and len(pdf) and all(pdf[c].iloc[-1] == kept[0][c].iloc[0] for c in _CELL):
                kept.append(pdf)
                continue
            joined, kept[:] = _together([*kept, pdf]) if kept else pdf, []
            found = [out for cell in cells(joined, False) if (out := of(cell)) is not None] if len(joined) else []
            if found:
                yield _together(found)
        if kept:
            found = [out for cell in cells(_together(kept), True) if (out := of(cell)) is not None]
            if found:
                yield _together(found)

    return run


def _candidates(own: pd.DataFrame, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (a < b) of rows of a cell whose upper bound reaches the threshold and that no earlier table holds; between the two row groups only, if the cell has two."""
    codes, n, t = Codes.read(own, int(own["dim"].iloc[0])), len(own), int(own["t"].iloc[0])
    bits, tables = layout(int(own["n"].iloc[0]), threshold)
    keys = _keys(own["sign"].tolist(), bits, tables)[:, :t]
    group = own["s"].to_numpy() if own["i"].iloc[0] != own["j"].iloc[0] else None
    for at in range(0, n, _BLOCK):
        for to in range(at, n, _WIDTH):
            rows, others = slice(at, min(n, at + _BLOCK)), slice(to, min(n, to + _WIDTH))
            a, b = np.nonzero(codes.bounds(rows, others) >= threshold)
            a, b = a + at, b + to
            fit = a < b
            if group is not None:
                fit &= group[a] != group[b]
            if t:
                fit &= ~(keys[a] == keys[b]).any(axis=1)
            if fit.any():
                yield a[fit], b[fit]


def _flag(threshold: float) -> Callable[[pd.DataFrame], pd.DataFrame | None]:
    """The rows of a cell that have a candidate."""

    def flag(own: pd.DataFrame) -> pd.DataFrame | None:
        met = np.zeros(len(own), bool)
        for a, b in _candidates(own, threshold):
            met[a] = met[b] = True
        return own[met] if met.any() else None

    return flag


def _link(threshold: float) -> Callable[[pd.DataFrame], pd.DataFrame | None]:
    """The links of a cell, from the vectors: each row's number of them and the smallest row it reaches."""

    def link(own: pd.DataFrame) -> pd.DataFrame | None:
        n, copies, cid = len(own), own["copies"].to_numpy(), own["cid"].to_numpy()
        unit = unit_rows(np.stack(own["x"].to_numpy()).astype(np.float64))
        links, root = np.zeros(n, np.int64), np.arange(n)
        for a, b in _candidates(own, threshold):
            hit = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
            a, b = a[hit], b[hit]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            root = root[local_roots(n, root[a], root[b])[root]] if len(a) else root
        low = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(low, root, cid)
        out = pd.DataFrame({"cid": cid, "links": links, "root": low[root]})
        return out[out["links"] > 0]

    return link


def embedding_near_duplicates(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Vectors of equal, non-null label with cosine >= threshold are linked: one row per input row with vec_id, n_links, component_id, kept.

    n_links counts the other rows linked directly; component_id is the smallest id reachable by links, itself included; kept
    says that the row has that id. Null labels, null, empty or zero vectors and vectors with null or non-finite components
    link with nothing, nor do rows with a null id. Equal vectors of a label are linked as copies without being compared;
    repeated ids are rows of their own, whose labels and vectors may differ. Vectors of different lengths are not linked. An
    empty table gives no rows; other columns are ignored. No pair below the threshold is linked; a pair above it is missed
    with a probability below MISS where its label has several tables, and beyond EPS deviations of the estimate.
    """
    x = F.col(vec_col)
    ok = F.col(label_col).isNotNull() & F.forall(x, lambda c: F.coalesce((F.abs(c) < float("inf")) & ~F.isnan(c), F.lit(False))) & F.exists(x, lambda c: c != 0)
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.when(ok, x).alias("x"))
    valid = rows.where("x IS NOT NULL AND vec_id IS NOT NULL").withColumns({"h1": F.xxhash64("label", "x"), "h2": F.xxhash64(F.lit(7), "label", "x")})
    # classes of equal vectors, told by 128 bits; a class has a number of its own
    classes = valid.groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.any_value("label").alias("label"), F.any_value("x").alias("x"))
    classes = stash(classes.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    sizes = stash(classes.groupBy("label").agg(F.count("*").alias("n")), "label-sizes")
    coded = stash(join_small(classes.select("cid", "label", "x"), sizes, ["label"], F.col("cid")).mapInPandas(_encode(threshold), _CODED), "vector-codes")
    counted = coded.mapInPandas(_tabled(threshold, False), "label string, dim int, t int, key bigint").groupBy(*_BUCKET).count()
    hot = stash(counted.where(F.col("count") > CELL_ROWS).select(*_BUCKET, F.ceil(F.col("count") / CELL_ROWS).cast("int").alias("g")), "hot-buckets")
    tabled = join_small(coded.mapInPandas(_tabled(threshold, True), f"{_CODED}, t int, key bigint"), hot, _BUCKET, F.col("cid")).withColumn("g", F.coalesce("g", F.lit(1)))
    dealt = tabled.withColumn("s", F.pmod(F.xxhash64("cid"), F.col("g")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    dealt = dealt.withColumns({"i": F.least("s", "other"), "j": F.greatest("s", "other")}).drop("g", "other")
    in_cells = lambda df: df.repartition(*_CELL).sortWithinPartitions(*_CELL)
    near = stash(in_cells(dealt).mapInPandas(_by_cell(_flag(threshold)), dealt.schema), "candidates")
    exact = near.join(classes.select("cid", "copies", "x"), "cid")
    found = stash(in_cells(exact).mapInPandas(_by_cell(_link(threshold)), "cid bigint, links bigint, root bigint"), "vector-links")
    linked = found.groupBy("cid").agg(F.sum("links").alias("links"))
    comp = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    named = classes.select("h1", "h2", "cid", "rep", "copies").join(linked, "cid", "left").join(comp.withColumnRenamed("node", "cid"), "cid", "left")
    named = stash(named.select("h1", "h2", "rep", F.coalesce("component_id", "cid").alias("comp"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "vector-components")
    smallest = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    out = valid.select("vec_id", "h1", "h2").join(named.join(smallest, "comp").drop("comp", "rep"), ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    out = out.unionByName(rows.where("x IS NULL OR vec_id IS NULL").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")))
    drop(classes, sizes, coded, hot, near, found, comp)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
