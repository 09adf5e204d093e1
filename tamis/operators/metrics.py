"""Evaluation and bookkeeping aggregates. Counts and unrounded ratios; rounding is left to presentation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


def _ratio(a: Column, b: Column, empty: float) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(empty))


def _f1(p: Column, r: Column) -> Column:
    return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def flag_histogram(records: DataFrame) -> DataFrame:
    """(flag, n), most frequent first, ties by name; no_flag stands for records without one."""
    none = F.array(F.lit("no_flag"))
    return records.select(F.explode(F.when(F.size("flags") > 0, F.col("flags")).otherwise(none)).alias("flag")).groupBy("flag").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "flag")


def verdict_stats(records: DataFrame) -> DataFrame:
    """Counts and shares of keep, fixed and dropped; shares of nothing are null."""
    kinds = ("keep", "fixed", "dropped")
    n = records.agg(F.count("*").alias("total"), *(F.count_if(F.col("validation") == k).alias(f"n_{k}") for k in kinds))
    return n.select("*", *(F.try_divide(F.col(f"n_{k}"), F.col("total")).alias(f"share_{k}") for k in kinds))


def flag_diff(records: DataFrame) -> DataFrame:
    """(flag, added, removed) over fixed records: flags against original_flags."""
    fixed = records.where("validation = 'fixed'").withColumn("was", F.coalesce("original_flags", F.array().cast("array<string>")))
    change = fixed.select(F.explode(F.concat(F.transform(F.array_except("flags", "was"), lambda f: F.struct(f.alias("flag"), F.lit(1).alias("d"))), F.transform(F.array_except("was", "flags"), lambda f: F.struct(f.alias("flag"), F.lit(-1).alias("d"))))).alias("c")).select("c.*")
    return change.groupBy("flag").agg(F.count_if(F.col("d") > 0).alias("added"), F.count_if(F.col("d") < 0).alias("removed"))


def micro_metrics(results: DataFrame) -> DataFrame:
    """One row: predicted, truth and shared flags over all results, precision (1 if nothing was predicted), recall (1 if there is no truth), F1, format compliance (0 without results)."""
    p, t = F.array_distinct("predicted"), F.array_distinct("ground_truth")
    n = results.agg(F.count("*").alias("n_results"), *(F.coalesce(F.sum(F.size(x)), F.lit(0)).alias(c) for c, x in (("n_predicted", p), ("n_truth", t), ("n_correct", F.array_intersect("predicted", "ground_truth")))), F.count_if("format_ok").alias("n_format_ok"))
    n = n.withColumn("precision", _ratio(F.col("n_correct"), F.col("n_predicted"), 1.0)).withColumn("recall", _ratio(F.col("n_correct"), F.col("n_truth"), 1.0))
    return n.withColumn("f1", _f1(F.col("precision"), F.col("recall"))).withColumn("format_compliance", _ratio(F.col("n_format_ok"), F.col("n_results"), 0.0))


def per_flag_metrics(results: DataFrame) -> DataFrame:
    """(flag, tp, fp, fn, precision, recall), by flag; ratios of nothing are 0. One pass: each result names its flags with their kind."""
    p, t = F.array_distinct("predicted"), F.array_distinct("ground_truth")
    named = lambda x, k: F.transform(x, lambda f: F.struct(f.alias("flag"), F.lit(k).alias("k")))
    kinds = results.select(F.explode(F.concat(named(F.array_intersect(p, t), "tp"), named(F.array_except(p, t), "fp"), named(F.array_except(t, p), "fn"))).alias("x")).select("x.*")
    n = kinds.groupBy("flag").agg(*(F.count_if(F.col("k") == k).alias(k) for k in ("tp", "fp", "fn")))
    return n.select("*", _ratio(F.col("tp"), F.col("tp") + F.col("fp"), 0.0).alias("precision"), _ratio(F.col("tp"), F.col("tp") + F.col("fn"), 0.0).alias("recall")).orderBy("flag")


def no_flag_accuracy(results: DataFrame) -> DataFrame:
    """(total, correct, hallucinated, accuracy) over results whose truth is empty; no row if there are none."""
    own = results.where(F.size("ground_truth") == 0).agg(F.count("*").alias("total"), F.count_if(F.size("predicted") == 0).alias("correct")).where("total > 0")
    return own.select("total", "correct", (F.col("total") - F.col("correct")).alias("hallucinated"), (F.col("correct") / F.col("total")).alias("accuracy"))


METRICS = ("format_compliance", "precision", "recall", "f1")


def compare_models(base: DataFrame, tuned: DataFrame) -> DataFrame:
    """(metric, base, tuned, delta, sign): the four metrics of two one-row tables; sign is `+` only for a gain."""
    turn = lambda df, name: df.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, METRICS)), F.array(*(F.col(m) for m in METRICS)))).alias("metric", name))
    both = turn(base, "base").join(turn(tuned, "tuned"), "metric").withColumn("delta", F.col("tuned") - F.col("base"))
    return both.withColumn("sign", F.when(F.col("delta") > 0, "+").otherwise(""))


def length_stats(lengths: DataFrame, col: str = "n") -> DataFrame:
    """One row: count, min, max, mean, median, p95, p99, the percentiles by upper nearest rank (sorted[min(int(count * q), count - 1)]). The lengths are counted by value first, so the order is taken over distinct lengths only."""
    by_value = lengths.groupBy(F.col(col).alias("v")).agg(F.count("*").alias("c"))
    run = by_value.withColumn("upto", F.sum("c").over(Window.orderBy("v"))).withColumn("total", F.sum("c").over(Window.partitionBy(F.lit(0))))
    at = lambda rank: F.min(F.when(F.col("upto") > rank, F.col("v")))
    q = lambda x: at(F.least(F.floor(F.col("total") * F.lit(x)), F.col("total") - 1))
    n = F.col("total")
    out = run.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("count"), F.min("v").alias("min"), F.max("v").alias("max"), (F.sum(F.col("v") * F.col("c")) / F.sum("c")).alias("mean"), ((at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2).alias("median"), q(0.95).alias("p95"), q(0.99).alias("p99"))
    return out


def length_advice(stats: DataFrame) -> DataFrame:
    return stats.select("p95", F.when(F.col("p95") <= 1024, "1024").when(F.col("p95") <= 2048, "2048").otherwise("warn").alias("advice"))


def pass_rate(cases: DataFrame) -> DataFrame:
    """(cases, passed, rate): a case passes if the answer contains what is expected."""
    return cases.agg(F.count("*").alias("cases"), F.count_if(F.contains("raw", F.col("expected"))).alias("passed")).withColumn("rate", F.try_divide(F.col("passed"), F.col("cases")))


def training_steps(rows: int, batch: int, accumulation: int, epochs: int, warmup_ratio: float) -> tuple[int, int]:
    """(all steps, warm-up steps) of a training run."""
    steps = rows // (batch * accumulation) * epochs
    return steps, int(steps * warmup_ratio)


def observed(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, Observation]:
    """df, and what a run of it counts on the way: rows, and the rows that hold each condition; no second pass. The observation's get() waits for the run."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *(F.count_if(c).alias(k) for k, c in counts.items())), seen


def throughput(seen: Observation, seconds: float) -> dict[str, float]:
    """The counts of a finished run, its seconds, and rows per minute."""
    counts = dict(seen.get)
    return {**counts, "seconds": seconds, "rows_per_minute": counts["rows"] * 60 / seconds if seconds > 0 else 0.0}


def rates(log: DataFrame, at: str, every: str = "1 minute", **counts: Column) -> DataFrame:
    """(start, rows, the counts, rows_per_minute) of the rows of a log in each window of time; rows without a time are left out."""
    own = F.window(F.col(at).cast("timestamp"), every)
    n = log.groupBy(own.alias("w")).agg(F.count("*").alias("rows"), *(F.count_if(c).alias(k) for k, c in counts.items()))
    minutes = (F.unix_seconds("w.end") - F.unix_seconds("w.start")) / F.lit(60.0)
    return n.select(F.col("w.start").alias("start"), "rows", *counts, (F.col("rows") / minutes).alias("rows_per_minute"))
