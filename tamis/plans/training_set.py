"""From labelled records to training data: the steps in the order in which they have to be taken, each a DataFrame operation.

Only the exact split walks records in order; everything before it is one lazy plan. The result is a set of lazy tables, so a
dry run is to look at the counts and write nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.functions.prompts import SYSTEM_PROMPT, chat_record
from tamis.operators import curation as C
from tamis.operators import retrieval as V
from tamis.operators.metrics import flag_histogram
from tamis.schemas import RUNTIME_TIERS, literals, normalise_records


@dataclass(frozen=True)
class TrainingSet:
    """Settings of a training set."""

    vocabulary: list[str] = field(default_factory=lambda: list(RUNTIME_TIERS))
    seeds_per_flag: int = 2
    use_context: bool = True
    caps: dict[str, int] = field(default_factory=dict)
    negative_ratio: float = 1.0
    split: str = "80/10/10"
    #: Whether to follow the sequential rule, which walks all records in one task, or to deal strata by hash.
    exact_split: bool = False
    top_k: int = 3
    seed: int = 42
    system_prompt: str = SYSTEM_PROMPT


@dataclass
class BuiltSet:
    """seeds (flag, pos, chunk_text), records with their split, and chat records per split."""

    seeds: DataFrame | None
    records: DataFrame
    chats: dict[str, DataFrame]

    def counts(self) -> DataFrame:
        """(split, flag, n): how often each flag occurs in each split."""
        parts = [flag_histogram(self.records.where(F.col("split") == s)).withColumn("split", F.lit(s)).select("split", "flag", "n") for s in C.SPLITS]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])


def curate(records: DataFrame, settings: TrainingSet) -> tuple[DataFrame | None, DataFrame]:
    """(seeds, records): rejected records and unknown flags gone, first of each text, seeds set aside, flags and negatives capped."""
    clean = C.strip_unknown_flags(C.drop_rejected(normalise_records(records)), literals(settings.vocabulary))
    first = C.dedup_first(clean)
    seeds, rest = C.select_seeds(first, settings.seeds_per_flag, settings.vocabulary) if settings.use_context else (None, first)
    return seeds, C.cap_negatives(C.cap_flags(rest, settings.caps, settings.seed), settings.negative_ratio, settings.seed)


def build(records: DataFrame, settings: TrainingSet, embed: Callable[[Column], Column] = V.hashed_embedding) -> BuiltSet:
    """Records (pos and the columns of a labelled record) as chat records of three splits, each chunk with the passages nearest to it as context, itself excluded."""
    seeds, curated = curate(records, settings)
    split = C.split_exact(curated, settings.split) if settings.exact_split else C.split_by_stratum(curated, settings.split, settings.seed).select("pos", "split")
    placed = curated.join(split, "pos")
    user = F.col("chunk_text")
    if seeds is not None:
        passages = V.passage_ids(seeds.withColumnRenamed("chunk_text", "passage"), prefix="real_").withColumn("id", F.xxhash64("id")).withColumn("embedding", embed(F.col("passage")))
        queries = placed.select(F.col("pos").alias("query_id"), embed(F.col("chunk_text")).alias("embedding"), F.md5("chunk_text").alias("own"))
        # one more than asked for, so that the chunk itself can be left out
        hits = V.top_k(queries, passages, settings.top_k + 1).join(queries.select("query_id", "own"), "query_id").join(passages.select("id", F.md5("passage").alias("theirs")), "id")
        gathered = V.gather_hits(V.drop_self(hits, F.col("own") == F.col("theirs"), settings.top_k).select("query_id", "rank", "id", "distance"), passages)
        placed = V.wrap(placed, gathered.withColumnRenamed("query_id", "pos"), key="pos")
        user = F.col("wrapped")
    chats = placed.select("pos", "split", chat_record(user, F.col("flags"), settings.system_prompt).alias("messages"))
    return BuiltSet(seeds, placed, {s: chats.where(F.col("split") == s).select("pos", "messages") for s in C.SPLITS})
