"""Sharding by rendezvous hashing: every shard bids for every record key, and the best bid takes the record.

Only built-in functions are used. A bid is -ln(u) / weight, where u in (0, 1) follows from key and shard alone, and the least
one wins; so a shard wins in proportion to its weight, and a shard that is added can only take records for itself, as all other
bids stay. The shard of a record is an expression: placing records needs no shuffle and no state.

Slots number the records of a shard. Records with the same id, size and checksum are counted first; then each shard is cut
into cells by a hash, counted, and shifted by the cells before, so that neither a shard nor a hot key is numbered in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.llm.common import stash, unused

#: Different records that a cell of a shard holds, about.
CELL_ROWS = 1 << 16
#: Equal records whose slots are written from one row.
RUN = 1 << 16
LAW = "key"


def record_key(id_col: str) -> Column:
    """The key that decides on a record, as text; null is `-`."""
    return F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("-"))


def _bid(key: Column, shard: int, weight: float) -> Column:
    """The bid of one shard: 52 bits of a digest as a number in (0, 1), its logarithm over the weight."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{shard}"))), 1, 13), 16, 10).cast("bigint")
    return F.struct((-F.log((bits + F.lit(0.5)) / F.lit(float(1 << 52))) / F.lit(float(weight))).alias("wait"), F.lit(shard).alias("shard"))


def best_bid(key: Column, weights: list[float], first: int = 0) -> Column:
    """struct(wait, shard) of the winner among the shards first, first + 1, ... of the weights; a weight of 0 takes no part."""
    if any(w < 0 or not math.isfinite(w) for w in weights) or not any(weights):
        raise ValueError("weights must be finite, none negative, and not all 0")
    return F.array_min(F.array(*(_bid(key, first + s, w) for s, w in enumerate(weights) if w > 0)))


def shard_of(key: Column, weights: list[float]) -> Column:
    return best_bid(key, weights)["shard"]


def shard_records(records: DataFrame, weights: list[float], grown: float | None = 1.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Where each record goes: id_col, size, text_crc32, law, shard, slot, grown_shard.

    id and weights decide on the shard, 0 to len(weights) - 1; grown_shard is the one with a further shard of the weight
    `grown` (null, if that is None): the same or the new one. size: UTF-8 bytes of the text, plus 1; text_crc32: of the same
    bytes, unsigned; a null text has none, so 1 and 0. Slots run without gaps from 0 in each shard, in an order that a digest of
    id, size and checksum decides. One row per input row; repeated ids meet in one shard, null ids are one key; an empty table
    gives no rows. Other columns are ignored.
    """
    text = F.col(f"`{text_col}`")
    size, crc = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint"), F.coalesce(F.crc32(text), F.lit(0)).cast("bigint")
    # equal records have equal places; they are counted here, so that no group of them is sorted
    same = records.select(F.col(f"`{id_col}`").alias("id"), size.alias("size"), crc.alias("crc")).groupBy("id", "size", "crc").agg(F.count("*").alias("n"))
    key = record_key("id")
    placed = same.withColumn("best", best_bid(key, weights)).withColumn("place", F.md5(F.concat_ws(":", key, "size", "crc")))
    after = F.least("best", best_bid(key, [grown], len(weights)))["shard"] if grown else F.lit(None).cast("int")
    placed = stash(placed.select("id", "size", "crc", "n", "place", F.col("best.shard").alias("shard"), after.alias("grown")), "placed")
    cells = max(1, math.ceil(placed.count() / len(weights) / CELL_ROWS))
    # the first 32 bits of the place, scaled to the cells: cells are in the order of places
    at = F.conv(F.substring("place", 1, 8), 16, 10).cast("bigint") * F.lit(cells)
    placed = placed.withColumn("cell", F.shiftright(at, 32).cast("int"))
    sums = placed.groupBy("shard", "cell").agg(F.sum("n").alias("rows"))
    before = sums.select("shard", "cell", (F.sum("rows").over(Window.partitionBy("shard").orderBy("cell")) - F.col("rows")).alias("before"))
    own = F.sum("n").over(Window.partitionBy("shard", "cell").orderBy("place", "id", "size", "crc")) - F.col("n")
    met = placed.withColumn("own", own).join(before, ["shard", "cell"])
    numbered = stash(met.select("id", "size", "crc", "n", "shard", "grown", (F.col("before") + F.col("own")).alias("first")), "numbered")
    slots = lambda df: df.withColumn("slot", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)))
    # runs of more than RUN equal records are dealt out before they are written row by row
    part = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / RUN)))
    many = numbered.where(F.col("n") > RUN).withColumn("part", part)
    many = many.withColumn("first", F.col("first") + F.col("part") * RUN).withColumn("n", F.least(F.lit(RUN).cast("bigint"), F.col("n") - F.col("part") * RUN)).drop("part").repartition("shard", "first")
    out = slots(numbered.where(F.col("n") <= RUN)).unionByName(slots(many))
    return out.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit(LAW).alias("law"), "shard", "slot", F.col("grown").alias("grown_shard"))


def write_shards(records: DataFrame, path: str, weights: list[float], id_col: str = "doc_id", shard_col: str = "shard") -> None:
    """The records as a Parquet table with a folder for each shard that has any; all columns stay, one named shard_col is replaced. Large shards get several files and small ones few, by size and not by key, so that hot keys do not matter."""
    kept = [f"`{c}`" for c in records.columns if c.lower() != shard_col.lower()]
    key, own = record_key(id_col), unused(records.columns, "_shard")[0]
    dealt = records.withColumn(own, shard_of(key, weights)).select(*kept, F.col(own).alias(shard_col))
    dealt.hint("rebalance", F.col(f"`{shard_col}`")).write.partitionBy(shard_col).parquet(path)
