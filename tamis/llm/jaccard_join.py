"""N-gram Jaccard join by token-combination prefixes.

A text's tokens are its distinct 5-word shingles, as 64-bit hashes. All texts order their tokens by an estimated frequency
(from a count sketch over all documents and a summary of the heaviest tokens), then hash. Of two sets with Jaccard >= t, the first n - ceil(t n) + 1 tokens of both
(their prefixes) share the first token that the sets share. If that is a rare one, the sets meet in the list of this token.
If not, all tokens that they share are frequent, and e more tokens of both hold e more shared ones. Frequent tokens are dealt by
hash over groups: class 2 over m2 groups, class 3, the most frequent, over m3; with e = m2 + 2 * m3, some group of class 2 has
two shared tokens or some group of class 3 has three. So rare tokens of the prefix are indexed singly, and of the extended
prefix of sets that have frequent tokens in their prefix the pairs within each group of class 2 and the triples within each of
class 3. Groups grow with the set, so that a set has about as many combinations as tokens at any size. Sets of unequal size
must use the same groups: these follow from the power of two of the larger one, which the smaller one indexes too.

Copies (equal sets) are one node. Lists of the index are not expanded into pairs, and a list whose tokens are expected in more
than CELL documents is dealt over cells. First every node of a cell is verified against the cell's smallest and largest node,
then the cells' own ones against those of the list; what that links is one component. Then only nodes of one list that are still
in different components are paired, cell by cell, and verified, so that no link between components is lost. Verified are the
whole sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.llm import common as C
from tamis.llm.common import bytes_of, components, drop, join_small, stash
from tamis.llm.words import mix, shingle_sets

WIDTH = 5
#: Similarity as a percentage: linked if 100 * |A and B| >= PERCENT * |A or B|.
PERCENT = 80
#: The frequency sketch has a counter for so many characters, within these powers of two, and is sent in rows of _ROW counters, merged FAN tasks at a time.
SKETCH_CHARS, SKETCH_BITS = 128, (16, 22)
_ROW, FAN = 1 << 14, 16
#: Counters are read in a byte: up to their mean, which other tokens bring, in MEAN steps; above it as STEPS * log2(1 + excess).
STEPS, MEAN = 6, 63
#: Tokens that the summary of the heaviest holds: all that make up more than one in so many.
HEAVY = 4096
#: Bits of the filter for an id that is asked for, and of the whole filter at most.
FILTER_BITS, MOST_FILTER_BITS = 10, 28
#: Tokens of class 3 are so many times as frequent as the rarest of class 2.
CLASS_3 = 64
#: Documents that a cell of a list may be expected to hold.
CELL = 4096
SALTS = 16
#: Documents whose shingles a task holds at a time.
SLICE = 64


def _least(n: np.ndarray | int, percent: int):
    """Tokens that a set of n shares at least with any similar one."""
    return -(-n * percent // 100)


@cache
def groups(power: int, percent: int) -> tuple[int, int]:
    """(m2, m3): the groups of class 2 and of class 3, where the larger set has 2^power tokens or more, below twice that. Where similar sets may share too few tokens, m3 is 0, or both are, and frequent tokens are indexed singly."""
    longest = (2 << power) - 1
    prefix, shared = longest - _least(longest, percent) + 1, _least(1 << power, percent)
    m2, m3 = max(1, prefix // 24), prefix // 8
    if m3 > 1 and shared > m2 + 2 * m3:
        return m2, m3
    return (m2 if shared > m2 else 1, 0) if shared > 1 else (0, 0)


@cache
def _choices(n: int, k: int) -> np.ndarray:
    """All choices of k of n positions, each ascending."""
    return np.array(list(combinations(range(n), k)), np.int64).reshape(-1, k)


def node_of(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


class Heaviest:
    """The heaviest of a run of tokens, by Misra and Gries: counts that are too low by one in HEAVY of all tokens at most. Summaries add up."""

    def __init__(self, keys: np.ndarray | None = None, counts: np.ndarray | None = None):
        self.keys, self.counts = (np.zeros(0, np.uint64), np.zeros(0, np.int64)) if keys is None else (keys, counts)
        self.waiting, self.held = [], 0

    def add(self, tokens: np.ndarray) -> None:
        self.waiting.append(tokens)
        self.held += len(tokens)
        if self.held > 16 * HEAVY:
            self.settle()

    def settle(self) -> None:
        if self.waiting:
            keys, counts = np.unique(np.concatenate(self.waiting), return_counts=True)
            self.waiting, self.held = [], 0
            self.merge(Heaviest(keys, counts))

    def merge(self, other: Heaviest) -> None:
        keys, at = np.unique(np.concatenate([self.keys, other.keys]), return_inverse=True)
        counts = np.zeros(len(keys), np.int64)
        np.add.at(counts, at, np.concatenate([self.counts, other.counts]))
        if len(keys) > HEAVY:
            counts -= np.partition(counts, len(keys) - HEAVY - 1)[len(keys) - HEAVY - 1]
        self.keys, self.counts = keys[counts > 0], counts[counts > 0]

    def packed(self) -> bytes:
        self.settle()
        return self.keys.tobytes() + self.counts.astype(np.uint64).tobytes()

    @staticmethod
    def unpacked(b: bytes) -> Heaviest:
        both = np.frombuffer(b, np.uint64)
        return Heaviest(both[: len(both) // 2], both[len(both) // 2 :].astype(np.int64))


#: The number of the row that holds a summary of the heaviest among those of a sketch.
_HEAVIEST = -1


def _survey(width: int, bits: int):
    """(doc_id, n, node) of every document, and the rows of a sketch of its task's token counts, the last one its heaviest."""

    def survey(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sketch, heaviest = np.zeros(1 << bits, np.int32), Heaviest()
        for whole in parts:
            for at in range(0, len(whole), SLICE):
                pdf, n, node = whole.iloc[at : at + SLICE], [], []
                for tokens in shingle_sets(pdf["text"].tolist(), width):
                    n.append(len(tokens))
                    node.append(node_of(tokens) if len(tokens) else None)
                    np.add.at(sketch, (tokens >> np.uint64(64 - bits)).astype(np.int64), 1)
                    heaviest.add(tokens)
                yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy(), "n": np.array(n, np.int64), "node": pd.array(node, dtype="Int64"), "task": None, "at": None, "counts": None})
        if sketch.any():
            rows = [*(small(sketch[k : k + _ROW]) for k in range(0, len(sketch), _ROW)), heaviest.packed()]
            yield pd.DataFrame({"doc_id": None, "n": None, "node": pd.array([None] * len(rows), dtype="Int64"), "task": TaskContext.get().partitionId(), "at": [*range(len(rows) - 1), _HEAVIEST], "counts": rows})

    return survey


def small(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as they take, which the first byte says."""
    most = int(counts.max())
    size = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4
    return bytes([size]) + counts.astype(f"<u{size}").tobytes()


def _sum_rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The sums of sketch rows with the same (task, at), where `task` numbers what is merged so far."""
    sums: dict[tuple[int, int], np.ndarray | Heaviest] = {}
    for pdf in parts:
        for task, at, b in zip(pdf["task"], pdf["at"], pdf["counts"], strict=True):
            if at == _HEAVIEST:
                sums.setdefault((task, at), Heaviest()).merge(Heaviest.unpacked(b))
            else:
                sums[task, at] = sums.get((task, at), 0) + _counts(b)
    if sums:
        packed = [s.packed() if a == _HEAVIEST else small(np.minimum(s, 2**32 - 1)) for (_, a), s in sums.items()]
        yield pd.DataFrame({"task": [t for t, _ in sums], "at": [a for _, a in sums], "counts": packed}).astype({"task": "int32", "at": "int32"})


def _levels(mean: float, heaviest: Heaviest, bits: int):
    """The last sums, as levels, without what the heaviest tokens bring to them."""

    def levels(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for pdf in parts:
            for at, b in zip(pdf["at"], pdf["counts"], strict=True):
                sums[at] = sums.get(at, 0) + _counts(b)
        slot = (heaviest.keys >> np.uint64(64 - bits)).astype(np.int64)
        for at, counts in sums.items():
            own = slot // _ROW == at
            np.subtract.at(counts, slot[own] % _ROW, heaviest.counts[own])
            yield pd.DataFrame({"at": [at], "levels": [level_of(counts, mean).astype(np.uint8).tobytes()]}).astype({"at": "int32"})

    return levels


def _counts(row: bytes) -> np.ndarray:
    return np.frombuffer(row, f"<u{row[0]}", offset=1).astype(np.int64)


def level_of(count: np.ndarray | float, mean: float = 0.0):
    """The level of a counter of which `mean` is what other tokens bring."""
    count = np.maximum(count, 0)
    low = np.floor(MEAN * count / max(mean, 1.0))
    return np.minimum(np.where(count <= mean, low, MEAN + np.floor(STEPS * np.log2(1.0 + np.maximum(count - mean, 0)))), 255)


def most_of(level: np.ndarray) -> np.ndarray:
    """Documents that a token above the mean may be expected to have."""
    return 2.0 ** ((np.asarray(level, float) - MEAN + 1) / STEPS) - 1


def _sketch(found: DataFrame, bits: int) -> tuple[bytes, Heaviest, int]:
    """The sketch as a byte a counter, the heaviest tokens, and the level above which a token is frequent: more than 12 deviations above what other tokens bring to a counter. Rows of the tasks' sketches are merged up a tree of fan-in FAN."""
    rows = found.where("at IS NOT NULL").select("task", "at", "counts")
    tasks, total = found.agg(F.max("task") + 1, F.sum("n")).first()
    tasks, mean = tasks or 1, (total or 0) / (1 << bits)
    while tasks > FAN:
        tasks = math.ceil(tasks / FAN)
        rows = rows.withColumn("task", F.floor(F.col("task") / FAN).cast("int")).repartition("at", "task").mapInPandas(_sum_rows, "task int, at int, counts binary")
    heaviest = Heaviest()
    for r in rows.where(F.col("at") == _HEAVIEST).collect():  # FAN rows of up to HEAVY tokens
        heaviest.merge(Heaviest.unpacked(r["counts"]))
    levels = np.zeros(1 << bits, np.uint8)
    for r in rows.where(F.col("at") != _HEAVIEST).repartition("at").mapInPandas(_levels(mean, heaviest, bits), "at int, levels binary").collect():
        levels[r["at"] * _ROW : (r["at"] + 1) * _ROW] = np.frombuffer(r["levels"], np.uint8)
    return levels.tobytes(), heaviest, int(level_of(mean + 12 * mean**0.5 + 8, mean))


class Postings:
    """The index entries of sets of tokens; levels is the sketch, of all tokens but the heaviest, whose counts are known; tokens above `rare` are of class 2, those above `often` of class 3."""

    def __init__(self, levels: np.ndarray, heaviest: Heaviest, rare: int, often: int, percent: int):
        self.levels, self.rare, self.often, self.percent = levels, rare, often, percent
        self.heavy, self.heavy_levels = heaviest.keys, level_of(heaviest.counts).astype(np.uint8)
        self.shift = np.uint64(64 - int(math.log2(len(levels))))

    def level(self, tokens: np.ndarray) -> np.ndarray:
        level = self.levels[(tokens >> self.shift).astype(np.int64)]
        if len(self.heavy):
            at = np.minimum(np.searchsorted(self.heavy, tokens), len(self.heavy) - 1)
            level = np.where(self.heavy[at] == tokens, self.heavy_levels[at], level)
        return level

    def of(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(keys, places, levels) of a sorted set. A place says: if two similar sets share no earlier entry, so many of this one's tokens are not shared. A level bounds the documents that have the entry."""
        n = len(tokens)
        p = n - _least(n, self.percent) + 1
        powers = range(n.bit_length() - 1, (n * 100 // self.percent).bit_length())
        more = {power: m2 + 2 * m3 for power in powers for m2, m3 in (groups(power, self.percent),)}
        level = self.level(tokens)
        order = np.argsort(level, kind="stable")[: p + max(more.values())]  # tokens are sorted by hash already
        first, level = tokens[order], level[order]
        single = int(np.searchsorted(level[:p], self.rare, side="right"))
        keys, places, levels = [first[:single]], [np.arange(single)], [level[:single]]
        if single == p:
            return keys[0], places[0], levels[0]
        for power, e in more.items():
            heavy, own = first[single : p + e], level[single : p + e]
            m2, m3 = groups(power, self.percent)
            if not m2:
                keys.append(mix(heavy + np.uint64(power)))
                places.append(np.arange(single, p))
                levels.append(own)
                continue
            cut = int(np.searchsorted(own, self.often, side="right")) if m3 else len(heavy)
            for k, a, b, m in ((2, 0, cut, m2), (3, cut, len(heavy), m3)):
                if b - a < k:
                    continue
                part = (heavy[a:b] >> np.uint64(11)).astype(np.int64) % m
                by = np.argsort(part, kind="stable")
                edge = np.append(np.flatnonzero(np.diff(part[by], prepend=-1)), b - a)
                chosen = [by[x + _choices(int(y - x), k)] + a for x, y in zip(edge[:-1], edge[1:], strict=True) if y - x >= k]
                if chosen:
                    chosen = np.concatenate(chosen)
                    key = np.full(len(chosen), power * 4 + k, np.uint64)
                    for c in range(k):
                        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + heavy[chosen[:, c]])
                    keys.append(key)
                    # no rare token is shared then, and of those before the last of it at most e
                    places.append(single + np.maximum(0, chosen[:, -1] - e))
                    levels.append(own[chosen[:, 0]])  # the rarest token of it comes first
        return np.concatenate(keys), np.concatenate(places), np.concatenate(levels)


def _postings(sketch, heaviest: Heaviest, rare: int, often: int, width: int, percent: int, most: int):
    """(cell, list, node, n, at) of the index, once per node and task. cell: the list's key or, of a list that is dealt over cells, the cell's; list: the key of a list that is dealt, else null. A list is dealt if its token is frequent and more than `most` documents are expected in it; a rare token's is short, whatever its counter holds."""

    def postings(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, seen = Postings(np.frombuffer(sketch.value, np.uint8), heaviest, rare, often, percent), set()
        for whole in parts:
            for at in range(0, len(whole), SLICE):
                keys, places, levels, nodes, sizes = [], [], [], [], []
                for tokens in shingle_sets(whole["text"].iloc[at : at + SLICE].tolist(), width):
                    # a set of one token is similar to its copies only, above 50 percent
                    if (len(tokens) > 1 or percent <= 50) and len(tokens) and (node := node_of(tokens)) not in seen:
                        seen.add(node)
                        for into, new in zip((keys, places, levels), index.of(tokens), strict=True):
                            into.append(new)
                        nodes.append(node)
                        sizes.append(len(tokens))
                if keys:
                    times = [len(k) for k in keys]
                    key, node = np.concatenate(keys), np.repeat(np.array(nodes, np.int64), times)
                    level = np.concatenate(levels)
                    cells = np.where(level > rare, np.ceil(most_of(level) / most), 1).astype(np.uint64)
                    dealt = cells > 1
                    cell = key.copy()
                    cell[dealt] = mix(key[dealt] + (mix(node[dealt].view(np.uint64)) % cells[dealt] + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03))
                    lists = pd.array(key.view(np.int64), dtype="Int64")
                    lists[~dealt] = pd.NA
                    yield pd.DataFrame({"cell": cell.view(np.int64), "list": lists, "node": node, "n": np.repeat(np.array(sizes, np.int32), times), "at": np.concatenate(places).astype(np.int32)})

    return postings


def _sets(width: int):
    def sets(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in parts:
            for at in range(0, len(whole), SLICE):
                found = [t for t in shingle_sets(whole["text"].iloc[at : at + SLICE].tolist(), width) if len(t)]
                yield pd.DataFrame({"node": np.array([node_of(t) for t in found], np.int64), "tokens": [t.tobytes() for t in found]})

    return sets


def _compare(percent: int):
    """Rows sorted by (a, salt, role): the set of a (role 0), then those of its partners."""

    def compare(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, own = None, np.zeros(0, np.uint64)
        for pdf in parts:
            hit_a, hit_b = [], []
            for r in pdf.itertuples(index=False):
                tokens = np.frombuffer(r.tokens, np.uint64)
                if r.role == 0:
                    a, own = r.a, tokens
                    continue
                if a != r.a:
                    raise ValueError("a partner came without its node")
                at = np.searchsorted(own, tokens)
                at[at == len(own)] = 0
                shared = int((own[at] == tokens).sum())
                if 100 * shared >= percent * (len(own) + len(tokens) - shared):
                    hit_a.append(a)
                    hit_b.append(r.b)
            yield pd.DataFrame({"a": np.array(hit_a, np.int64), "b": np.array(hit_b, np.int64)})

    return compare


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar; pairs are a stashed table, sets (node, tokens). Sets are shuffled once to what asks for them and once to their pairs, whatever the size; a node asks at most once for each salt of a center."""
    rows = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int").alias("salt"))
    partners = rows.select(F.col("b").alias("node"), "a", "salt", F.lit(1).alias("role"), "b")
    centers = rows.select(F.col("a").alias("node"), "a", "salt").distinct().select("node", "a", "salt", F.lit(0).alias("role"), F.col("a").alias("b"))
    met = sets.hint("merge").join(partners.unionByName(centers), "node").select("a", "salt", "role", "b", "tokens")
    met = met.repartition("a", "salt").sortWithinPartitions("a", "salt", "role", "b")
    return met.mapInPandas(_compare(percent), "a bigint, b bigint")


def _can_be_similar(x: str, y: str, percent: int) -> Column:
    """Whether two entries of a list, named by prefix, can be the first that similar sets share: each set less its tokens before them must hold the overlap that both sizes ask for."""
    n, m, i, j = (F.col(f"{p}.{c}") for c in ("n", "at") for p in (x, y))
    return F.least(n - i, m - j) * (100 + percent) >= (n + m) * percent


def _can_have_partner(x: str, near: str, percent: int) -> Column:
    """Whether an entry x can be similar to any that has at least as many tokens before it as the entry `near` of its list."""
    return F.col(f"{x}.n") * (100 - percent) >= F.col(f"{x}.at") * 100 + F.col(f"{near}.at") * percent


def _stars(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of the nodes x with the nodes `near` and `low` of their cell or list."""
    stars = rows.select("x", F.explode(F.array("near", "low")).alias("to")).where(F.col("x.node") != F.col("to.node")).where(_can_be_similar("x", "to", percent))
    return stars.select(F.col("to.node").alias("a"), F.col("x.node").alias("b"))


def _open_pairs(index: DataFrame, comp: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), a < b, of nodes that stand in one list, can be similar there, and are in different components so far."""
    named = join_small(index.select(F.coalesce("list", "cell").alias("key"), "x.node", "x.n", "x.at"), comp, ["node"], F.col("node"))
    named = named.withColumn("comp", F.coalesce("component_id", "node")).drop("component_id")
    # lists are counted before rows move: a list whose nodes are all in one component goes no further
    lists = named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("rows")).where("lo < hi")
    lists = stash(lists.select("key", F.ceil(F.col("rows") / CELL).cast("int").alias("cells")), "open-keys")
    rows = stash(join_small(named, lists, ["key"], F.col("node"), how="inner"), "open-lists")
    # a list above CELL rows is dealt over cells (i, j) of row groups
    s = F.pmod(F.xxhash64("node"), F.col("cells")).cast("int")
    dealt = rows.withColumn("s", s).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    dealt = dealt.withColumns({"i": F.least("s", "other"), "j": F.greatest("s", "other")}).drop("other", "cells")
    x, y = dealt.alias("x"), dealt.alias("y")
    same = (F.col("x.key") == F.col("y.key")) & (F.col("x.i") == F.col("y.i")) & (F.col("x.j") == F.col("y.j"))
    apart = (F.col("x.node") < F.col("y.node")) & (F.col("x.comp") != F.col("y.comp")) & ((F.col("x.s") != F.col("y.s")) | (F.col("x.i") == F.col("x.j")))
    met = x.join(y, same & apart & _can_be_similar("x", "y", percent))
    return met.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def _bits_of(ids: np.ndarray, bits: int) -> np.ndarray:
    """Four bits that stand for each id."""
    keys = ids.astype(np.int64).view(np.uint64)
    return np.concatenate([(mix(keys + np.uint64(seed)) >> np.uint64(64 - bits)).astype(np.int64) for seed in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD1B54A32D192ED03)])


def id_filter(ids: DataFrame, n: int) -> tuple[bytes, int]:
    """(filter, its bits as a power of two): a Bloom filter of n ids (doc_id, a written table), made by tasks and merged piece by piece."""
    bits = min(max(math.ceil(math.log2(FILTER_BITS * n + 1)), 16), MOST_FILTER_BITS)

    def make(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = np.zeros(1 << (bits - 3), np.uint8)
        for pdf in parts:
            on = _bits_of(pdf["doc_id"].to_numpy(np.int64), bits)
            np.bitwise_or.at(own, on >> 3, (1 << (on & 7)).astype(np.uint8))
        for at in range(0, len(own), _ROW):
            if own[at : at + _ROW].any():
                yield pd.DataFrame({"at": [at], "part": [own[at : at + _ROW].tobytes()]})

    def merge(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[int, np.ndarray] = {}
        for pdf in parts:
            for at, part in zip(pdf["at"], pdf["part"], strict=True):
                part = np.frombuffer(part, np.uint8)
                found[at] = found[at] | part if at in found else part
        for at, part in found.items():
            yield pd.DataFrame({"at": [at], "part": [part.tobytes()]})

    whole = np.zeros(1 << (bits - 3), np.uint8)
    schema = "at bigint, part binary"
    for r in ids.where("doc_id IS NOT NULL").mapInPandas(make, schema).repartition("at").mapInPandas(merge, schema).collect():
        whole[r["at"] : r["at"] + len(r["part"])] = np.frombuffer(r["part"], np.uint8)
    return whole.tobytes(), bits


def texts_of(rows: DataFrame, needed: DataFrame) -> DataFrame:
    """The rows (doc_id, text) whose id is in needed (a written table). Where the ids are too many to be broadcast, rows that a filter of them rules out stay where they are, and only the others move."""
    if bytes_of(needed) <= C.BROADCAST_BYTES:
        return rows.join(F.broadcast(needed), "doc_id", "left_semi")
    made, bits = id_filter(needed, needed.count())
    sent = rows.sparkSession.sparkContext.broadcast(made)

    def keep(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = np.frombuffer(sent.value, np.uint8)
        for pdf in parts:
            on = _bits_of(pdf["doc_id"].to_numpy(np.int64), bits)
            yield pdf[((own[on >> 3] >> (on & 7).astype(np.uint8)) & 1).reshape(4, -1).all(0)]

    return rows.where("doc_id IS NOT NULL").mapInPandas(keep, rows.schema).join(needed, "doc_id", "left_semi")


def jaccard_components(documents: DataFrame, percent: int = PERCENT, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row; component_id is the smallest doc_id reachable by links, itself included.

    Words are runs other than space and 0x09-0x0D, A-Z in lower case; a set holds the distinct shingles of `width` words, or
    the whole sequence if it is shorter. Rows are linked if 100 * shared >= percent * union. Null texts and texts without words
    have empty sets and link with nothing. One row per input row; rows of one id share no link by their id alone. Other
    columns are ignored; an empty table gives no rows. Links are a matter of 64-bit hashes of shingles and of sets.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be above 0 and at most 100")
    spark = documents.sparkSession
    rows = documents.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    chars = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(max(math.ceil(math.log2(chars / SKETCH_CHARS + 1)), SKETCH_BITS[0]), SKETCH_BITS[1])
    found = stash(rows.mapInPandas(_survey(width, bits), "doc_id bigint, n bigint, node bigint, task int, at int, counts binary"), "survey")
    docs = found.where("at IS NULL").select("doc_id", "n", "node")
    levels, heaviest, rare = _sketch(found, bits)
    sketch = spark.sparkContext.broadcast(levels)
    often = rare + int(STEPS * math.log2(CLASS_3))
    lists = rows.mapInPandas(_postings(sketch, heaviest, rare, often, width, percent, CELL), "cell bigint, list bigint, node bigint, n int, at int")
    by = Window.partitionBy("cell")
    own = F.struct("node", "n", "at")
    # of a cell, the node with the fewest tokens of its own stands nearest to all others; another one is its smallest
    near = F.min_by("x", F.struct("x.at", "x.node"))
    ends = lists.select("cell", "list", own.alias("x")).withColumn("near", near.over(by)).withColumn("low", F.min("x").over(by)).withColumn("high", F.max("x.node").over(by))
    ends = ends.withColumn("rows", F.count("*").over(by)).where("low.node < high OR list IS NOT NULL").where(_can_have_partner("x", "near", percent) | F.col("list").isNotNull())
    index = stash(ends.drop("high"), "lists")
    # cells of one list meet by their own ends
    heads = index.where("list IS NOT NULL").select("list", F.explode(F.array("near", "low")).alias("x")).distinct()
    heads = stash(heads, "cell-ends")
    tops = heads.groupBy("list").agg(near.alias("near"), F.min("x").alias("low"))
    first = stash(_stars(index, percent).unionByName(_stars(heads.join(tops, "list"), percent)).distinct(), "star-pairs")
    # written, as a semi-join would else be pushed below the grouping and bring all copies of a text to one task
    reps = stash(docs.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id")), "nodes")

    def sets_of(pairs: DataFrame, have: DataFrame | None = None) -> DataFrame:
        """The sets (node, tokens) of the nodes in pairs, from one document each; those that `have` holds are not made again."""
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        nodes = nodes if have is None else nodes.join(have.select("node"), "node", "left_anti")
        needed = stash(reps.join(nodes, "node", "left_semi").select("doc_id").distinct(), "needed")
        if have is not None and not needed.take(1):
            return have
        out = stash(texts_of(rows, needed).mapInPandas(_sets(width), "node bigint, tokens binary"), "sets")
        drop(needed)
        return out if have is None else have.unionByName(out)

    sets = sets_of(first)
    links = stash(_verify(first, sets, percent), "star-links")
    comp = components(links)
    # in a list of two the one star was the only pair
    rest = _open_pairs(index.where("rows > 2 OR list IS NOT NULL"), comp, percent)
    done = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    second = stash(rest.join(done, ["a", "b"], "left_anti"), "open-pairs")
    others = sets_of(second, sets)
    more = stash(_verify(second, others, percent), "open-links")
    final = components(links.unionByName(more))
    named = reps.join(final, "node", "left").select("node", "doc_id", F.coalesce("component_id", "node").alias("comp"))
    smallest = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    nodes = stash(named.join(smallest, "comp").select("node", "component_id"), "node-smallest")
    out = join_small(docs.where("node IS NOT NULL"), nodes, ["node"], F.col("doc_id"), how="inner")
    drop(index, heads, reps, first, sets, others, links, comp, second, more, final)
    sketch.destroy()
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(docs.where("node IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def one_of_each(documents: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """The documents that have the smallest doc_id of their component; all columns stay.

    Rows that repeat an id and its text are one document. An id with several texts stays only if no row of it is similar to a
    document with a smaller id. Rows with a null id stay as they are.
    """
    found = stash(jaccard_components(documents, percent, width).select("doc_id", "component_id"), "components")
    copies = stash(found.where("doc_id <> component_id").select("doc_id").distinct(), "near-copies")
    twice = stash(found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated-ids")
    left = join_small(documents, copies, ["doc_id"], F.col("doc_id"), how="left_anti")
    once = join_small(left, twice, ["doc_id"], F.col("doc_id"), how="left_anti")
    more = join_small(left, twice, ["doc_id"], F.col("doc_id"), how="left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(more)
