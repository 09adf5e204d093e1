"""Labelling packages with a model in two passes: propose flags per chunk, then check the proposed ones.

What was written before is left out by key, so that a run takes up where another ended. Every pass writes its answers before
they are read again: a model is not asked twice because a plan is evaluated twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.functions.parsing import in_vocabulary, json_flags, json_verdicts
from tamis.functions.prompts import fits_prompt, flag_check_prompt, labelling_prompt, validation_prompt
from tamis.functions.text import pack_paragraphs, strip
from tamis.operators.detection import Detector, detect, json_answer
from tamis.operators.labeling import apply_verdicts, not_done, revalidate, stop_after_flagged
from tamis.operators.ordinals import with_ordinals
from tamis.schemas import Taxonomy, literals

KEY = ["rfp_id", "chunk_index"]
ATTEMPTS = 3


def paragraph_chunks(packages: DataFrame, max_words: int = 400, overlap_words: int = 50, separator: str = "\n\n") -> DataFrame:
    """rfp_id, chunk_index, chunk_text of packages (rfp_id, text)."""
    return packages.where(strip(F.col("text")) != "").select("rfp_id", F.posexplode(pack_paragraphs(F.col("text"), max_words, overlap_words, separator)).alias("chunk_index", "chunk_text"))


def _answers(rows: DataFrame, make_detector: Callable[[], Detector], path: str, in_flight: int = 1, key: list[str] = KEY) -> DataFrame:
    """key, raw answers, attempts and errors, added to what is written at path. An answer that is no JSON is asked for again, ATTEMPTS times in all, and is then without flags; a call that fails has an error, and its key is open."""
    asked = detect(rows.select(*key, "prompt"), make_detector, Taxonomy({}), attempts=ATTEMPTS, read=json_answer, in_flight=in_flight)
    asked.select(*key, "raw", "attempts", "parsed", "error").write.mode("append").parquet(path)
    return answered(rows.sparkSession, path, key)


def answered(spark: SparkSession, path: str, key: list[str] = KEY) -> DataFrame:
    """The answers at path that were given; of several for a key, as after a run that ended midway, one."""
    return spark.read.parquet(path).where("error IS NULL").dropDuplicates(key)


def failed(spark: SparkSession, path: str, key: list[str] = KEY) -> DataFrame:
    """key and error of what has no answer yet."""
    return spark.read.parquet(path).where("error IS NOT NULL").join(answered(spark, path, key), key, "left_anti").groupBy(*key).agg(F.max("error").alias("error"))


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _open(work: DataFrame, path: str, key: list[str] = KEY) -> DataFrame:
    """Work that has no answer at path yet."""
    spark = work.sparkSession
    return not_done(work, answered(spark, path, key), key) if exists(spark, path) else work


def propose(packages: DataFrame, make_detector: Callable[[], Detector], vocabulary: dict[str, str], path: str, separator: str = "\n\n", in_flight: int = 1) -> DataFrame:
    """First pass: records (rfp_id, chunk_index, chunk_text, flags) of all packages, chunks already answered at path not asked again. vocabulary: flag -> definition. Failures have no flags and are asked again by the next run."""
    chunks = paragraph_chunks(packages, separator=separator)
    work = _open(chunks, path)
    definitions = F.create_map(*(F.lit(x) for pair in vocabulary.items() for x in pair))
    asked = work.where(fits_prompt(F.col("chunk_text"))).withColumn("prompt", labelling_prompt(F.col("chunk_text"), definitions))
    answers = _answers(asked, make_detector, path, in_flight)
    flags = in_vocabulary(json_flags(F.coalesce("raw", F.lit(""))), literals(list(vocabulary)))
    return chunks.join(answers, KEY, "left").select("rfp_id", "chunk_index", "chunk_text", F.coalesce(flags, literals([])).alias("flags"))


def propose_until(packages: DataFrame, make_detector: Callable[[], Detector], vocabulary: dict[str, str], path: str, most: int, wave: int = 64, separator: str = "\n\n", in_flight: int = 1) -> DataFrame:
    """propose() for packages by id, `wave` of them at a time, until `most` records have flags; the records up to that one. What is asked beyond it is less than a wave, and is answered already when the next run wants more."""
    ordered = with_ordinals(packages.orderBy("rfp_id"), "package_number")
    total, upto, records = ordered.count(), 0, None
    while records is None or (upto < total and records.where(F.size("flags") > 0).limit(most).count() < most):
        upto += wave
        records = propose(ordered.where(F.col("package_number") < upto).drop("package_number"), make_detector, vocabulary, path, separator, in_flight)
    return first_flagged(records, most)


def first_flagged(records: DataFrame, most: int) -> DataFrame:
    """Records up to the `most`-th that has a flag, by package and chunk."""
    seq = F.concat_ws("|", "rfp_id", F.lpad(F.col("chunk_index").cast("string"), 9, "0"))
    return stop_after_flagged(records.withColumn("seq", seq).withColumn("flagged", F.size("flags") > 0), most).drop("seq", "flagged")


def check(records: DataFrame, make_detector: Callable[[], Detector], vocabulary: dict[str, str], path: str, black: list[str] = (), in_flight: int = 1) -> DataFrame:
    """Second pass: a prompt per flagged record about its own flags; the answers can only take flags away."""
    definitions = F.create_map(*(F.lit(x) for pair in vocabulary.items() for x in pair))
    asked = _open(records.where(F.size("flags") > 0), path).withColumn("prompt", flag_check_prompt(F.col("chunk_text"), F.col("flags"), definitions, literals(list(black))))
    answers = _answers(asked, make_detector, path, in_flight).select(*KEY, json_flags(F.coalesce("raw", F.lit(""))).alias("answered"))
    return revalidate(records, answers, literals(list(vocabulary)), KEY)


def validate(records: DataFrame, make_detector: Callable[[], Detector], vocabulary: list[str], path: str, batch_size: int = 10, in_flight: int = 1) -> DataFrame:
    """Review of records (with pos) in batches of batch_size neighbours, a prompt a batch: records with validation, original_flags and drop_reason. Batches answered at path are not asked again; one whose call fails, or says nothing of a record, keeps it as it is."""
    index = F.pmod(F.col("pos"), F.lit(batch_size)).cast("int")
    item = F.struct(index.alias("index"), "chunk_text", "flags", "confidence", "adversarial")
    batches = records.groupBy(F.floor(F.col("pos") / batch_size).cast("bigint").alias("batch_id")).agg(F.array_sort(F.collect_list(item)).alias("items"))
    # an item's number in the prompt is its place in the list; a batch may lack some
    asked = _open(batches, path, ["batch_id"]).withColumn("prompt", validation_prompt(F.col("items")))
    answers = _answers(asked, make_detector, path, in_flight, ["batch_id"]).select("batch_id", "raw")
    said = answers.join(batches.select("batch_id", F.transform("items", lambda x: x["index"]).alias("numbers")), "batch_id")
    said = said.select("batch_id", "numbers", F.posexplode(json_verdicts(F.coalesce("raw", F.lit("")))).alias("seq", "v")).where(F.col("v.index").between(0, F.size("numbers") - 1))
    verdicts = said.select("batch_id", F.get("numbers", F.col("v.index")).alias("index"), "seq", "v.verdict", "v.corrected_flags", "v.reason")
    return apply_verdicts(records, verdicts, literals(vocabulary), batch_size)
