"""A store of passages with embeddings: ids, top-k by cosine distance (see vectors), context for chunks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.functions.prompts import context_block, extract_chunk, of_roles
from tamis.operators.vectors import top_k

#: Positions whose passages are ranked together.
RUN = 1 << 16


def passage_ids(passages: DataFrame, order_col: str = "pos", prefix: str = "") -> DataFrame:
    """passages with id: flag and the ordinal of the passage within its flag in this call, from 0. Positions are whole numbers: passages are counted within runs of RUN positions and shifted by the runs before, so that no flag is ranked in one task."""
    keyed = passages.withColumn("_run", F.floor(F.col(order_col) / RUN))
    sizes = keyed.groupBy("flag", "_run").agg(F.count("*").alias("_n"))
    shift = sizes.withColumn("_before", F.sum("_n").over(Window.partitionBy("flag").orderBy("_run")) - F.col("_n")).drop("_n")
    n = F.row_number().over(Window.partitionBy("flag", "_run").orderBy(order_col)) - 1
    met = keyed.withColumn("_at", n).join(shift, ["flag", "_run"])
    return met.withColumn("id", F.concat(F.lit(prefix), "flag", F.lit("_"), (F.col("_before") + F.col("_at")).cast("string"))).select(*passages.columns, "id")


def new_passages(passages: DataFrame, stored: DataFrame, order_col: str = "pos", prefix: str = "") -> DataFrame:
    """Passages whose id the store does not hold. Ids decide, not texts: another passage of the same ordinal is skipped."""
    return passage_ids(passages, order_col, prefix).join(stored.select("id"), "id", "left_anti")


def hashed_embedding(x: Column, dimensions: int = 64) -> Column:
    """An embedding without a model: counts of words by hash, scaled to unit length."""
    slots = F.transform(F.filter(F.split(F.lower(x), r"(?U)\W+"), lambda w: w != ""), lambda w: F.pmod(F.xxhash64(w), F.lit(dimensions)).cast("int"))
    counts = F.transform(F.sequence(F.lit(0), F.lit(dimensions - 1)), lambda d: F.size(F.filter(slots, lambda s: s == d)).cast("double"))
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, c: a + c * c))
    return F.transform(F.array(counts), lambda v: F.transform(v, lambda c: F.when(norm(v) > 0, c / norm(v)).otherwise(F.lit(0.0))))[0]


def drop_self(hits: DataFrame, same: Column, k: int) -> DataFrame:
    """Of k + 1 over-fetched hits per query, those that are not the chunk itself, ranked again, the first k."""
    order = Window.partitionBy("query_id").orderBy("rank")
    return hits.where(~same & (F.col("rank") <= k + 1)).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def gather_hits(hits: DataFrame, passages: DataFrame) -> DataFrame:
    """(query_id, hits): the passages of each query's hits, nearest first; at most k of them."""
    met = hits.join(passages.select("id", "passage", "flag"), "id")
    return met.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "passage", "flag", "distance"))).alias("hits"))


def wrap(chunks: DataFrame, gathered: DataFrame, key: str = "query_id", text_col: str = "chunk_text") -> DataFrame:
    """chunks with `wrapped`: the chunk in the context block of its hits, plain without any."""
    met = chunks.join(gathered, key, "left")
    return met.withColumn("wrapped", F.when(F.size(F.coalesce("hits", F.array().cast("array<struct<rank:int,passage:string,flag:string,distance:double>>"))) > 0, context_block(F.transform("hits", lambda h: h["passage"]), F.col(text_col))).otherwise(F.col(text_col))).drop("hits")


def unwrap_chat(chats: DataFrame) -> DataFrame:
    """chats with chunk_text: the chunk inside each record's user message."""
    return chats.withColumn("chunk_text", extract_chunk(F.get(of_roles(F.col("messages"), "user"), F.lit(0))["content"]))


def rewrap_chat(messages: Column, wrapped: Column) -> Column:
    """Chat messages with the user's content replaced; the others stay."""
    return F.transform(messages, lambda m: F.when(m["role"] == "user", F.struct(m["role"].alias("role"), wrapped.alias("content"))).otherwise(F.struct(m["role"].alias("role"), m["content"].alias("content"))))


class PassageStore:
    """Passages in a Parquet folder: id, flag, passage, embedding. embed: Column -> Column makes embeddings."""

    def __init__(self, spark, path: str, embed: Callable[[Column], Column] = hashed_embedding):
        self.spark, self.path, self.embed = spark, path, embed

    def read(self) -> DataFrame:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        schema = "id string, flag string, passage string, embedding array<double>"
        return self.spark.read.schema(schema).parquet(self.path) if fs.exists(at) else self.spark.createDataFrame([], schema)

    def count(self) -> int:
        return self.read().count()

    def add(self, passages: DataFrame, prefix: str = "") -> int:
        """Append passages (pos, flag, passage) whose id is new; returns how many."""
        before = self.count()
        new_passages(passages, self.read(), prefix=prefix).select("id", "flag", "passage", self.embed(F.col("passage")).alias("embedding")).write.mode("append").parquet(self.path)
        return self.count() - before

    def fill_once(self, read_seeds: Callable[[], DataFrame | None]) -> int:
        """Add seeds to an empty store; a store that holds passages, or missing seeds, change nothing."""
        seeds = read_seeds() if self.count() == 0 else None
        return self.add(seeds) if seeds is not None else 0

    def query(self, queries: DataFrame, k: int = 3) -> DataFrame:
        """(query_id, hits) of queries (query_id, text)."""
        stored = self.read().withColumn("name", F.col("id")).withColumn("id", F.xxhash64("name"))
        hits = top_k(queries.select("query_id", self.embed(F.col("text")).alias("embedding")), stored, k)
        return gather_hits(hits, stored)
