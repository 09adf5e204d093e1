"""Schemas, vocabularies and settings of the engine."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The flags a screening run knows, with their tiers; the black tier exists and is empty.
RUNTIME_TIERS = {
    "small_business_set_aside": "red",
    "lpta_source_selection": "red",
    "8a_set_aside": "blue",
    "sdvosb_set_aside": "blue",
    "hubzone_set_aside": "blue",
    "agile_methodology": "green",
    "oral_presentation": "green",
}
TIERS = ("black", "red", "green", "blue")
#: Answers that say that a chunk shows no flag.
NO_FLAG = "no_flag"
EMPTY_ANSWERS = ("no_flag", "none")

RECORD = T.StructType([
    T.StructField("rfp_id", T.StringType()),
    T.StructField("chunk_index", T.IntegerType()),
    T.StructField("chunk_text", T.StringType()),
    T.StructField("flags", T.ArrayType(T.StringType())),
    T.StructField("confidence", T.StringType()),
    T.StructField("adversarial", T.BooleanType()),
    T.StructField("validation", T.StringType()),
    T.StructField("original_flags", T.ArrayType(T.StringType())),
    T.StructField("drop_reason", T.StringType()),
])
CHAT = T.StructType([T.StructField("messages", T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])))])
SEED = T.StructType([T.StructField("flag", T.StringType()), T.StructField("passage", T.StringType())])
VERDICT = "array<struct<index:int,verdict:string,corrected_flags:array<string>,reason:string>>"
CHUNKS = "array<struct<chunk_text:string,flags:array<string>,confidence:string,adversarial:boolean>>"


@dataclass(frozen=True)
class Taxonomy:
    """A vocabulary of flags, each in one tier."""

    tiers: dict[str, str] = field(default_factory=lambda: dict(RUNTIME_TIERS))

    def __post_init__(self) -> None:
        unknown = set(self.tiers.values()) - set(TIERS)
        if unknown:
            raise ValueError(f"unknown tiers: {sorted(unknown)}")

    @property
    def flags(self) -> list[str]:
        return list(self.tiers)

    def of(self, tier: str) -> list[str]:
        return [f for f, t in self.tiers.items() if t == tier]

    def vocabulary(self) -> Column:
        return literals(self.flags)

    def table(self, spark: SparkSession) -> DataFrame:
        """flag_taxonomy(flag, tier)."""
        return spark.createDataFrame(list(self.tiers.items()), "flag string, tier string")

    def views(self, spark: SparkSession) -> DataFrame:
        """One row per tier that has flags: tier, flags (sorted)."""
        return self.table(spark).groupBy("tier").agg(F.array_sort(F.collect_set("flag")).alias("flags"))


@dataclass(frozen=True)
class Screening:
    """Settings of a screening run."""

    max_tokens: int = 512
    overlap_tokens: int = 64
    red_threshold: int = 999
    top_k: int = 3
    attempts: int = 2
    taxonomy: Taxonomy = field(default_factory=Taxonomy)


def literals(values: list[str]) -> Column:
    """An array<string> of literals, also of none."""
    return F.array(*(F.lit(v) for v in values)) if values else F.array().cast("array<string>")


def normalise_records(df: DataFrame) -> DataFrame:
    """Records with every column of RECORD: missing ones null, null flags empty, null adversarial false, null confidence `medium`; a null validation stays null. Other columns stay."""
    have = set(df.columns)
    for f in RECORD.fields:
        if f.name not in have:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df.withColumn("flags", F.coalesce("flags", literals([]))).withColumn("adversarial", F.coalesce("adversarial", F.lit(False))).withColumn("confidence", F.coalesce("confidence", F.lit("medium")))
