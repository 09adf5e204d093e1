"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same expected copies, target / source size. The whole part is given to all; the fractional
parts are rounded in pairs: mass moves at random between two documents, word for word, until one of them is at 0 or 1, so the
words taken stay as they were. Documents are dealt by a hash of their id into buckets of bounded size; each bucket leaves at
most one fractional document per source, and these residuals are paired again up a tree of fan-in FAN until one per source
remains, which a last draw settles. Large documents are paired first, so that what remains is small. Order and chance come
from sizes and hashes of id and text, so reruns agree however the rows are partitioned. Rows that repeat an id, its source and its text
are interchangeable; where there are more of them than a bucket holds, they are numbered, so that each number has a place of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.llm.common import BROADCAST_BYTES, bytes_of, cols, drop, join_small, stash, unused
from tamis.operators.ordinals import with_ordinals

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
BUCKET_ROWS = 1024
FAN = 64
_ENDS = 1e-9


def with_sizes(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """size: the number of words of the text; null: 0."""
    return documents.withColumn("size", F.coalesce(F.regexp_count(text_col, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint"))


def source_targets(sized: DataFrame, source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """One row per source: _key, source_size, target. Sources by code point, null last, weigh `weights`, repeating; targets share all words by weight, stop at `most` times the source's size, and the excess is shared again by weight until none is above."""
    source = F.col(source_col)
    totals = sized.groupBy(source.alias("source"), _key(source_col).alias("_key")).agg(F.sum("size").alias("source_size"))
    ordered = with_ordinals(totals.orderBy(F.col("source").isNull(), "source").select("_key", "source_size"), "place")
    weight = F.get(F.array(*map(F.lit, weights)), (F.col("place") % len(weights)).cast("int"))
    ranked = stash(ordered.select("_key", "source_size", weight.alias("weight")), "sources")
    cap = F.lit(most) * F.col("source_size")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, before = 0.0, None
    while level != before:
        before = level
        over = F.lit(level) * F.col("weight") > cap if level else F.col("source_size") == 0
        capped, free = ranked.agg(F.coalesce(F.sum(F.when(over, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0))).first()
        level = (total - capped) / free if free else 0.0
    return ranked.select("_key", "source_size", F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(F.least(F.lit(level) * F.col("weight"), cap.cast("double"))).alias("target"))


def _key(source_col: str):
    return F.when(F.col(source_col).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source_col).cast("string")))


def pivotal(p: np.ndarray, size: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Round the shares p in pairs, moving words between two documents until one of them is at 0 or 1; at most one share stays between. sum(p * size) and each mean stay."""
    out, c = p.astype(float), -1
    for j in range(len(out)):
        if not _ENDS < out[j] < 1 - _ENDS or size[j] == 0:
            out[j] = round(out[j]) if size[j] else float(u[j] < out[j])
            continue
        if c < 0:
            c = j
            continue
        up, down = min((1 - out[c]) * size[c], out[j] * size[j]), min(out[c] * size[c], (1 - out[j]) * size[j])
        move = up if u[j] * (up + down) < down else -down
        out[c] += move / size[c]
        out[j] -= move / size[j]
        for k in (c, j):
            if out[k] < _ENDS or out[k] > 1 - _ENDS:
                out[k] = round(out[k])
        c = j if 0 < out[j] < 1 else c if 0 < out[c] < 1 else -1
    return out


def _round_groups(by: list[str], p: str, size: str, u: str):
    """Rows sorted by group; the share of each row is rounded within its group."""

    def rounded(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: pd.DataFrame | None = None

        def done(pdf: pd.DataFrame) -> pd.DataFrame:
            share, words, chance = (pdf[c].to_numpy() for c in (p, size, u))
            start = np.flatnonzero((pdf[by] != pdf[by].shift()).any(axis=1).to_numpy())
            return pdf.assign(**{p: np.concatenate([pivotal(share[a:b], words[a:b], chance[a:b]) for a, b in zip(start, [*start[1:], len(pdf)], strict=True)])})

        for pdf in parts:
            pdf = pdf if kept is None else pd.concat([kept, pdf], ignore_index=True)
            same = (pdf[by] == pdf[by].iloc[-1]).all(axis=1).to_numpy()
            cut = len(pdf) - (int(np.argmin(same[::-1])) if not same.all() else len(pdf))
            kept = pdf.iloc[cut:].reset_index(drop=True)
            if cut:
                yield done(pdf.iloc[:cut].reset_index(drop=True))
        if kept is not None and len(kept):
            yield done(kept)

    return rounded


def repeated_keys(rows: DataFrame, key: list[str]) -> DataFrame | None:
    """The keys that several rows have, as a written table; None if there are none."""
    (n,) = unused(key, "_n")
    often = stash(rows.groupBy(*key).agg(F.count("*").alias(n)).where(F.col(n) > 1).select(*key), "repeated")
    if often.take(1):
        return often
    drop(often)
    return None


def number_repeats(rows: DataFrame, key: list[str], name: str, often: DataFrame | None) -> DataFrame:
    """rows with `name`: 0, or, for keys in `often`, the number of the row among those of its key, from 0. Counted per partition of a written table and then shifted, so that no key's rows meet in a task."""
    if often is None:
        return rows.withColumn(name, F.lit(0).cast("bigint"))
    part, no, before = unused([*rows.columns, name], "_part", "_no", "_before")
    written = stash(rows.withColumn(part, F.spark_partition_id()), "to-number")
    same = _same_key(key)
    few = small_side(often).alias("r")
    marked = written.alias("l").join(few, same, "left_semi").select("l.*")
    others = written.alias("l").join(few, same, "left_anti").select("l.*")
    counts = marked.groupBy(*key, part).agg(F.count("*").alias(no))
    shift = counts.withColumn(before, F.sum(no).over(Window.partitionBy(*key).orderBy(part)) - F.col(no)).drop(no)
    own = marked.withColumn(no, F.row_number().over(Window.partitionBy(*key, part).orderBy(F.lit(0))))
    met = own.alias("l").join(shift.alias("r"), same & (F.col(f"l.{part}") == F.col(f"r.{part}"))).select("l.*", F.col(f"r.{before}"))
    numbered = met.withColumn(name, F.col(before) + F.col(no) - 1).drop(before, no, part)
    return numbered.unionByName(others.withColumn(name, F.lit(0).cast("bigint")).drop(part))


def _chance(*cols: Column):
    """A number in (0, 1) by hash."""
    return (F.pmod(F.xxhash64(F.lit(17), *cols), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def _same_key(key: list[str]) -> Column:
    """Whether rows l and r have the same key, nulls included."""
    same = F.lit(True)
    for c in key:
        same &= F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return same


def small_side(df: DataFrame) -> DataFrame:
    """A written table, to be broadcast if its measured size allows it."""
    return F.broadcast(df) if bytes_of(df) <= BROADCAST_BYTES else df


def mix_sources(documents: DataFrame, keep: list[str] | None = None, source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Copies of each document such that each source's words come to its target: the columns `keep` (all, if None), size, source_size, target, copies, taken.

    taken = copies * size; copies are 0 to `most`, and target / source size on average. Every input row gives one row, repeated
    and null ids included; null sources are one source; null texts have size 0 and take nothing; a source without words has
    target 0. Columns of the new names are replaced, all other names are the caller's; an empty table gives no rows. A source's
    taken words differ from its target by less than one document's size.
    """
    new = ("size", "source_size", "target", "copies", "taken")
    names = [c for c in documents.columns if c.lower() not in new]
    keep = [c for c in (names if keep is None else keep) if c.lower() not in new]
    ident, key, text_hash, no, chance, base, share, bucket, node, up = unused(names, *("_id", "_key", "_hash", "_no", "_chance", "_base", "_share", "_bucket", "_node", "_up"))
    extra = [F.col(f"`{id_col}`").alias(ident), F.col(f"`{source_col}`").cast("string").alias(key), F.xxhash64(F.col(f"`{text_col}`")).alias(text_hash)]
    # sizes and hashes are written once; a text that is to be kept stays where it is and gets its copies by a join at the end
    apart = text_col.lower() in {c.lower() for c in keep}
    carried = [] if apart else keep
    rows = stash(with_sizes(documents.select(*cols(names)), text_col).select(*cols(carried), "size", *extra), "sizes")
    sums = stash(rows.groupBy(F.col(key).alias("source")).agg(F.sum("size").alias("size"), F.count("*").alias("rows")), "source-sizes")
    dealt_to = sums.select(_key("source").alias("_key"), F.ceil(F.col("rows") / BUCKET_ROWS).cast("int").alias("buckets"))
    targets = source_targets(sums.select("source", "size"), "source", weights, most).join(dealt_to, "_key")
    targets = stash(targets.select(F.col("_key").alias(key), "source_size", "target", F.col("buckets").alias(bucket)), "source-targets")
    buckets = targets.agg(F.max(bucket)).first()[0] or 1
    often = repeated_keys(rows, [ident, text_hash, key])
    rows = number_repeats(rows, [ident, text_hash, key], no, often).withColumn(key, _key(key))
    rows = join_small(rows.withColumn(chance, _chance(*map(F.col, (ident, text_hash, no)))), targets, [key], F.col(chance))
    # numbered rows go in runs of a bucket's size, which are dealt like single rows
    rows = rows.withColumn(bucket, F.pmod(F.xxhash64(ident, text_hash, F.floor(F.col(no) / BUCKET_ROWS), F.lit(3)), F.col(bucket)).cast("int"))
    part = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = rows.withColumn(base, F.floor(part).cast("int")).withColumn(share, part - F.floor(part))
    by = [key, bucket]
    rows = rows.select(*cols(carried), "size", "source_size", "target", *by, chance, base, share, ident, text_hash, no)
    sorted_ = rows.repartition(*by).sortWithinPartitions(*by, F.desc("size"), chance, ident, text_hash, no)
    dealt = stash(sorted_.mapInPandas(_round_groups(by, share, "size", chance), rows.schema), "rounded")
    # up the tree: one residual per source and bucket at first
    level = dealt.where((F.col(share) > 0) & (F.col(share) < 1)).select(*by, F.col(bucket).alias(node), "size", F.xxhash64(chance, F.lit(5)).alias("draw"), share)
    settled, nodes, old = [], buckets, []
    while nodes > 1:
        nodes = math.ceil(nodes / FAN)
        level = level.withColumn(node, F.floor(F.col(node) / FAN).cast("int")).withColumn(chance, _chance(F.col("draw"), F.col(node)))
        in_order = level.repartition(key, node).sortWithinPartitions(key, node, F.desc("size"), chance, bucket)
        at = stash(in_order.mapInPandas(_round_groups([key, node], share, "size", chance), level.schema), "residuals")
        settled.append(at.where((F.col(share) == 0) | (F.col(share) == 1)).select(*by, F.col(share).alias(up)))
        level = at.where((F.col(share) > 0) & (F.col(share) < 1))
        old.append(at)
    # the last one of a source is drawn too, so that its mean is its share
    settled.append(level.select(*by, (_chance(F.col("draw"), F.lit(9)) < F.col(share)).cast("double").alias(up)))
    ups = settled[0]
    for more in settled[1:]:
        ups = ups.unionByName(more)
    ups = stash(ups, "settled")
    drop(sums, targets, *old)
    open_ = F.col(share).between(_ENDS / 2, 1 - _ENDS / 2)
    out = dealt.where(~open_).withColumn(up, F.col(share)).unionByName(join_small(dealt.where(open_), ups, by, F.col(chance)).select(*cols(dealt.columns), up))
    copies = (F.col(base) + F.coalesce(up, F.lit(0.0)).cast("int")).cast("int")
    new_cols = ["size", "source_size", "target", copies.alias("copies"), (copies.cast("bigint") * F.col("size")).alias("taken")]
    if not apart:
        return out.select(*cols(keep), *new_cols)
    found = stash(out.select(ident, text_hash, key, no, *new_cols), "copies")
    drop(dealt, ups)
    whole = number_repeats(documents.select(*cols(keep), *extra), [ident, text_hash, key], no, often).withColumn(key, _key(key))
    met = whole.alias("l").join(small_side(found).alias("r"), _same_key([ident, text_hash, key, no]))
    return met.select(*(F.col(f"l.`{c}`") for c in keep), *(F.col(f"r.{c}") for c in new))


def take_copies(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Each row as many times as its copies say."""
    (copy,) = unused(mixed.columns, "_copy")
    return mixed.where("copies > 0").withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*cols(columns))
