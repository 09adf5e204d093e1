"""Screening documents: chunks, detection, and a decision per document.

One row-local pass to the flags of each chunk, one shuffle of small rows to gather them per document; a document's text is
never shuffled. Documents without chunks keep their default result without a join: an outer explode leaves them in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.functions.parsing import parse_flags, parse_ok
from tamis.functions.text import chunk_words
from tamis.operators.detection import Detector, detect, with_prompts
from tamis.operators.passage_index import PassageIndex
from tamis.schemas import TIERS, Screening, Taxonomy, literals


def chunks_of(documents: DataFrame, settings: Screening, id_col: str = "doc_id", text_col: str = "text", outer: bool = False) -> DataFrame:
    """id, chunk_index, chunk_text; outer: a document without chunks has a row of nulls."""
    explode = F.posexplode_outer if outer else F.posexplode
    return documents.select(id_col, explode(chunk_words(F.col(text_col), settings.max_tokens, settings.overlap_tokens)).alias("chunk_index", "chunk_text"))


def gather(detected: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, flags (sorted, distinct), unparsed_chunks, total_chunks from detected chunks; rows of null chunks count for nothing."""
    real = F.col("chunk_index").isNotNull()
    # flags of a vocabulary, so the sets stay small and combine before the shuffle
    sets = F.collect_set(F.when(real & F.col("parsed"), F.array_join(F.array_sort(F.array_distinct("flags")), "\n")))
    flags = F.array_sort(F.array_distinct(F.flatten(F.transform(sets, lambda s: F.split(s, "\n")))))
    return detected.groupBy(id_col).agg(F.filter(flags, lambda f: f != "").alias("flags"), F.count_if(real & ~F.col("parsed")).alias("unparsed_chunks"), F.count_if(real).alias("total_chunks"))


def filters_out(flags: Column, taxonomy: Taxonomy, red_threshold: int) -> Column:
    """Any black flag, or at least red_threshold red ones."""
    black, red = literals(taxonomy.of("black")), literals(taxonomy.of("red"))
    return (F.size(F.array_intersect(flags, black)) > 0) | (F.size(F.array_intersect(flags, red)) >= red_threshold)


def by_tier(flags: Column, taxonomy: Taxonomy) -> list[Column]:
    return [F.array_sort(F.array_intersect(flags, literals(taxonomy.of(t)))).alias(t) for t in TIERS]


def screen_answers(documents: DataFrame, answer: Callable[[Column], Column], settings: Screening, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """screen() with a detector that is an expression: all of it stays in built-in functions."""
    vocabulary = settings.taxonomy.vocabulary()
    rows = chunks_of(documents, settings, id_col, text_col, outer=True).select(id_col, "chunk_index", answer(F.col("chunk_text")).alias("raw"))
    detected = rows.select(id_col, "chunk_index", parse_flags(F.col("raw"), vocabulary).alias("flags"), parse_ok(F.col("raw"), vocabulary).alias("parsed"))
    return decide(gather(detected, id_col), settings)


def decide(gathered: DataFrame, settings: Screening) -> DataFrame:
    return gathered.withColumn("filter_out", filters_out(F.col("flags"), settings.taxonomy, settings.red_threshold))


def context_of(index: PassageIndex, k: int = 3, id_col: str = "doc_id") -> Callable[[DataFrame], DataFrame]:
    """A retrieve function for screen(): the k passages of the index that are nearest to each chunk."""

    def retrieve(chunks: DataFrame) -> DataFrame:
        keyed = chunks.withColumn("query_id", F.xxhash64(id_col, "chunk_index"))
        hits = index.query(keyed.select("query_id", F.col("chunk_text").alias("text")), k)
        return keyed.join(hits.select("query_id", F.transform("hits", lambda h: h["passage"]).alias("passages")), "query_id", "left").drop("query_id")

    return retrieve


def screen(documents: DataFrame, make_detector: Callable[[], Detector], settings: Screening, retrieve: Callable[[DataFrame], DataFrame] | None = None, id_col: str = "doc_id", text_col: str = "text", spread: int | None = None, in_flight: int = 1) -> DataFrame:
    """One row per document: id, flags, unparsed_chunks, total_chunks, filter_out.

    retrieve(chunks) may add a column passages (array<string>) that go into the prompts as context. Empty documents call no
    detector and pass. A chunk whose detection fails counts as unparsed."""
    chunks = chunks_of(documents, settings, id_col, text_col)
    if retrieve:
        chunks = retrieve(chunks)
    asked = with_prompts(chunks, F.col("passages") if retrieve else None).select(id_col, "chunk_index", "prompt")
    gathered = gather(detect(asked, make_detector, settings.taxonomy, settings.attempts, spread, in_flight=in_flight), id_col)
    all_docs = documents.select(id_col).join(gathered, id_col, "left")
    none = literals([])
    return decide(all_docs.select(id_col, F.coalesce("flags", none).alias("flags"), *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("unparsed_chunks", "total_chunks"))), settings)


def screen_files(files: DataFrame, answer: Callable[[Column], Column], settings: Screening, id_col: str = "path") -> DataFrame:
    """From uploads to decisions: one row per file of extract_files(), with id, rejected (why it is not screened: its read error, or `no text`), flags, unparsed_chunks, total_chunks and filter_out."""
    screened = screen_answers(files.select(id_col, F.coalesce("text", F.lit("")).alias("text")), answer, settings, id_col)
    why = F.when(F.col("error").isNotNull(), F.col("error")).when(F.trim("text") == "", F.lit("no text"))
    return files.select(id_col, why.alias("rejected")).join(screened, id_col)


def screen_by_tier(screened: DataFrame, taxonomy: Taxonomy, id_col: str = "doc_id") -> DataFrame:
    """id, the sorted flags of each tier, and the chunk counters."""
    return screened.select(id_col, *by_tier(F.col("flags"), taxonomy), "unparsed_chunks", "total_chunks")


def merge_tiers(old: DataFrame, new: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Downstream contract: an item with a black flag fails at once; else its tiers are united with those known before."""
    met = new.alias("n").join(old.alias("o"), id_col, "left")
    united = lambda t: F.array_sort(F.array_union(F.col(f"n.{t}"), F.coalesce(F.col(f"o.{t}"), literals([])))).alias(t)
    return met.select(id_col, (F.size("n.black") > 0).alias("failed"), *(united(t) for t in TIERS))


def report(screened: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, and a line that says what was decided."""
    named = F.when(F.size("flags") > 0, F.array_join("flags", ", ")).otherwise(F.lit("no flags"))
    head = F.when(F.col("filter_out"), F.lit("FILTER: ")).otherwise(F.lit("PASS: "))
    return screened.select(id_col, F.concat(head, named, F.lit(" in "), F.format_number("total_chunks", 0), F.lit(" chunks, "), F.format_number("unparsed_chunks", 0), F.lit(" unparsed")).alias("report"))
