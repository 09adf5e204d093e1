"""Applying a labeller's verdicts, resuming what was done before, stopping early, quotas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.functions.parsing import in_vocabulary, only_original
from tamis.operators.sampling import nth_per_group


def apply_verdicts(records: DataFrame, verdicts: DataFrame, vocabulary: Column, batch_size: int = 10) -> DataFrame:
    """Records (with pos) after a review of batches of batch_size: verdicts (batch_id, index, seq, verdict, corrected_flags, reason).

    KEEP and unknown or missing verdicts change nothing; FIX takes the known corrected flags; DROP rejects the record with a
    reason and leaves its flags. Of several verdicts for one index the last (by seq) holds. original_flags is set in any case."""
    last = verdicts.groupBy("batch_id", "index").agg(F.max_by(F.struct("verdict", "corrected_flags", "reason"), "seq").alias("v"))
    keyed = records.withColumn("batch_id", F.floor(F.col("pos") / batch_size).cast("bigint")).withColumn("index", (F.col("pos") % batch_size).cast("int"))
    what = F.upper(F.coalesce(F.col("v.verdict"), F.lit("KEEP")))
    fixed, dropped = what == "FIX", what == "DROP"
    met = keyed.join(last, ["batch_id", "index"], "left").withColumn("original_flags", F.col("flags"))
    met = met.withColumn("validation", F.when(fixed, "fixed").when(dropped, "dropped").otherwise("keep"))
    met = met.withColumn("flags", F.when(fixed, F.coalesce(in_vocabulary(F.col("v.corrected_flags"), vocabulary), F.array().cast("array<string>"))).otherwise(F.col("flags")))
    return met.withColumn("drop_reason", F.when(dropped, F.coalesce(F.col("v.reason"), F.lit("")))).drop("batch_id", "index", "v")


def revalidate(records: DataFrame, answers: DataFrame, vocabulary: Column, key: list[str]) -> DataFrame:
    """Second pass over flagged records: answers (key, answered). Records without flags are `skip` and ask nothing; the answer is cut to known flags that were there; the same set is `keep`, another `fixed` with original_flags."""
    none = F.lit(None).cast("array<string>")
    skipped = records.where(F.size("flags") == 0).withColumn("validation", F.lit("skip")).withColumn("original_flags", none)
    asked = records.where(F.size("flags") > 0).join(answers, key, "left")
    new = only_original(in_vocabulary(F.coalesce("answered", F.array().cast("array<string>")), vocabulary), F.col("flags"))
    same = F.array_sort(F.array_distinct(new)) == F.array_sort(F.array_distinct("flags"))
    done = asked.withColumn("validation", F.when(same, "keep").otherwise("fixed")).withColumn("original_flags", F.when(~same, F.col("flags"))).withColumn("flags", F.when(same, F.col("flags")).otherwise(new)).drop("answered")
    return skipped.unionByName(done, allowMissingColumns=True)


def not_done(work: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Work whose key no earlier run has written."""
    return work.join(done.select(*key).distinct(), key, "left_anti")


def not_done_by_text(work: DataFrame, done: DataFrame, text_col: str = "text") -> DataFrame:
    """Work whose text no earlier run has written; digests are compared, so texts are not shuffled twice over."""
    d = F.sha2(text_col, 256)
    return work.withColumn("_d", d).join(done.select(d.alias("_d")).distinct(), "_d", "left_anti").drop("_d")


def after_position(work: DataFrame, done: int, order_col: str = "pos") -> DataFrame:
    """Work from the ordinal on that an earlier run stopped at."""
    return work.where(F.col(order_col) >= done)


def stop_after_flagged(chunks: DataFrame, most: int, order: str = "seq", flagged: str = "flagged") -> DataFrame:
    """Chunks up to the `most`-th flagged one; all, if there are fewer. Only `most` keys are ranked."""
    cut = chunks.where(F.col(flagged)).select(order).orderBy(order).limit(most).agg(F.max(order), F.count("*")).first()
    return chunks.where(F.col(order) <= cut[0]) if cut[1] >= max(1, most) else chunks


def quota_status(found: DataFrame, targets: DataFrame) -> DataFrame:
    """(flag, n, target, filled) for every flag that has a target (no_flag among them): one count per occurrence."""
    n = found.groupBy("flag").agg(F.count("*").alias("n"))
    return targets.join(n, "flag", "left").select("flag", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), "target", (F.coalesce("n", F.lit(0)) >= F.col("target")).alias("filled"))


def quota_gated(found: DataFrame, target: int, rfp: str = "rfp_id", order: str = "seq") -> DataFrame:
    """Occurrences (flag, rfp) that a run takes which looks for a flag only while its count before the current package is below the target; a package may overshoot. That is, all up to the package of the target-th occurrence."""
    last = nth_per_group(found, "flag", [rfp, order], target).select("flag", F.col(rfp).alias("_last"))
    return found.join(F.broadcast(last), "flag", "left").where(F.col("_last").isNull() | (F.col(rfp) <= F.col("_last"))).drop("_last")  # one row per flag
