"""Building training sets out of labelled records: filters, first-wins dedup, seeds, caps, splits, cleaning rules."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.functions.parsing import in_vocabulary
from tamis.functions.text import has_dollar_amount, has_large_team, has_onsite_term
from tamis.operators.ordinals import with_ordinals
from tamis.operators.sampling import shuffled_by, take_first
from tamis.workspace import written

SPLITS = ("train", "eval", "test")
#: Equal neighbours that the exact split takes as one run.
RUN = 1 << 14


def drop_rejected(records: DataFrame) -> DataFrame:
    """Without those validated as `dropped`; those never validated stay."""
    return records.where(~F.col("validation").eqNullSafe("dropped"))


def strip_unknown_flags(records: DataFrame, vocabulary: Column) -> DataFrame:
    return records.withColumn("flags", in_vocabulary(F.col("flags"), vocabulary))


def is_positive() -> Column:
    return F.size("flags") > 0


def clean_seed(flag: str) -> Column:
    """Real, not rejected, and shows the flag."""
    return ~F.col("validation").eqNullSafe("dropped") & ~F.col("confidence").eqNullSafe("synthetic") & F.array_contains("flags", flag)


def seed_candidates(records: DataFrame) -> DataFrame:
    return records.where(~F.coalesce("adversarial", F.lit(False)))


def dedup_first(records: DataFrame, text_col: str = "chunk_text", order_col: str = "pos") -> DataFrame:
    """The first record of each text; records without a text are one. Digests with positions are grouped, and what leaves the records is the positions of later copies: texts are not shuffled for as long as these are few."""
    keyed = records.select(F.sha2(text_col, 256).alias("d"), F.col(order_col).alias("p"))
    repeated = keyed.groupBy("d").agg(F.min("p").alias("first"), F.count("*").alias("n")).where("n > 1").withColumnRenamed("d", "own")
    later = keyed.join(repeated, F.col("d").eqNullSafe(F.col("own")) & (F.col("p") > F.col("first"))).select("p")
    return records.join(later, F.col(order_col) == F.col("p"), "left_anti")


def seed_order() -> Column:
    """High confidence first, synthetic last."""
    return F.when(F.col("confidence") == "high", 0).when(F.col("confidence") == "synthetic", 2).otherwise(1)


def select_seeds(records: DataFrame, per_flag: int, vocabulary: list[str]) -> tuple[DataFrame, DataFrame]:
    """(seeds: flag, pos, chunk_text; the records that are none). Per flag, in the order of their first appearance, the best records that no other flag has reserved; at least one each.

    No flag can lose more candidates than all others reserve, so the best per_flag * flags candidates of each decide: a set
    that the vocabulary bounds, chosen from on the driver."""
    per_flag = max(1, per_flag)
    most = per_flag * max(1, len(vocabulary))
    named = seed_candidates(records).select("pos", seed_order().alias("rank"), F.posexplode("flags").alias("at", "flag")).where(F.col("flag").isin(vocabulary))
    # a flag that a record repeats is a candidate once
    rows = written(named.groupBy("flag", "pos", "rank").agg(F.min("at").alias("at")), "seed-candidates")
    first = {r["flag"]: (r["pos"], r["at"]) for r in rows.groupBy("flag").agg(F.min(F.struct("pos", "at")).alias("f")).select("flag", "f.*").collect()}
    best = rows.withColumn("n", F.row_number().over(Window.partitionBy("flag").orderBy("rank", "pos"))).where(F.col("n") <= most)
    by_flag: dict[str, list[int]] = {}
    for r in sorted(best.collect(), key=lambda r: r["n"]):
        by_flag.setdefault(r["flag"], []).append(r["pos"])
    taken: dict[int, str] = {}
    for flag in sorted(by_flag, key=first.__getitem__):
        for pos in [p for p in by_flag[flag] if p not in taken][:per_flag]:
            taken[pos] = flag
    picked = records.sparkSession.createDataFrame([(p, f) for p, f in taken.items()], "pos bigint, flag string")
    return records.join(F.broadcast(picked), "pos").select("flag", "pos", "chunk_text"), records.join(F.broadcast(picked), "pos", "left_anti")


def cap_negatives(records: DataFrame, ratio: float = 1.0, seed: int = 42) -> DataFrame:
    """All records with flags, and of the others at most int(positives * ratio), chosen at random."""
    counts = records.agg(F.count_if(is_positive()).alias("p"), F.count_if(~is_positive()).alias("n")).first()
    cap = int(counts["p"] * ratio)
    if counts["n"] <= cap:
        return records
    return records.where(is_positive()).unionByName(take_first(records.where(~is_positive()), shuffled_by(seed, "pos"), cap))


def cap_flags(records: DataFrame, caps: dict[str, int], seed: int = 42) -> DataFrame:
    """Without the records that a random cap of any of their flags drops; no caps, no change."""
    if not caps:
        return records
    limits = F.create_map(*(x for f, n in caps.items() for x in (F.lit(f), F.lit(n))))
    named = records.select("pos", F.explode("flags").alias("flag")).where(F.col("flag").isin(list(caps)))
    # of a flag over its cap, the first `cap` occurrences by hash stay
    kept = named.withColumn("n", F.row_number().over(Window.partitionBy("flag").orderBy(shuffled_by(seed, "flag", "pos"), "pos"))).where(F.col("n") <= max(caps.values())).where(F.col("n") <= F.element_at(limits, F.col("flag")))
    over = named.join(kept, ["pos", "flag"], "left_anti").select("pos").distinct()
    return records.join(over, "pos", "left_anti")


def parse_split(text: str) -> tuple[int, int, int]:
    """`a/b/c`, whole percentages that add up to 100."""
    parts = text.split("/")
    if len(parts) != 3 or sum(map(int, parts)) != 100:
        raise ValueError(f"a split is three whole percentages that add up to 100: {text}")
    return tuple(map(int, parts))


def split_targets(total: int, split: str) -> dict[str, int]:
    _, e, t = parse_split(split)
    sizes = {"eval": int(total * e / 100), "test": int(total * t / 100)}
    return {"train": total - sum(sizes.values()), **sizes}


class GreedySplitter:
    """Assigns records one by one, or runs of equal ones at once, to the split where their flags are most under-represented; its state is a counter per split and flag."""

    #: Runs up to this length are placed one by one.
    STEPS = 64

    def __init__(self, targets: dict[str, int], totals: dict[str, int]):
        self.targets, self.totals, self.n = targets, totals, sum(targets.values())
        self.size = dict.fromkeys(targets, 0)
        self.count = {s: dict.fromkeys(totals, 0) for s in targets}

    def fill(self, s: str, times: dict[str, int], more: int = 0) -> float:
        """How full a split is of the flags (each with its occurrences in a record), after `more` such records."""
        return max((self.count[s][f] + more * k) / max(self.totals[f] * self.targets[s] / self.n, 1) for f, k in times.items())

    def add(self, s: str, times: dict[str, int], records: int = 1) -> None:
        self.size[s] += records
        for f, k in times.items():
            self.count[s][f] += k * records

    def place(self, flags: list[str]) -> str:
        times = Counter(flags)
        room = [s for s in SPLITS if self.size[s] < self.targets[s]] if flags else []
        best = min(room, key=lambda s: self.fill(s, times)) if room else max(SPLITS, key=lambda s: self.targets[s] - self.size[s])
        self.add(best, times)
        return best

    def place_run(self, flags: list[str], length: int) -> None:
        """place() of `length` records with these flags. What a split offers its next records rises with each, so the run takes the `length` least offers of all, and how many of them are a split's is found by bisection."""
        if length <= self.STEPS:
            for _ in range(length):
                self.place(flags)
            return
        times = Counter(flags)
        room = {s: max(0, self.targets[s] - self.size[s]) for s in SPLITS}
        offer = (lambda s, j: self.fill(s, times, j)) if flags else (lambda s, j: j - room[s])
        taken = {}
        for at, s in enumerate(SPLITS):

            def before(j: int, at: int = at, s: str = s) -> int:
                """Offers that come before the j-th of s."""
                v = offer(s, j)
                return j + sum(bisect_left(range(room[t]), True, key=lambda i, t=t, k=k: offer(t, i) > v or (offer(t, i) == v and k > at)) for k, t in enumerate(SPLITS) if t != s)

            taken[s] = bisect_left(range(room[s]), length, key=before)
        for s, n in taken.items():
            self.add(s, times, n)


def _flag_totals(records: DataFrame) -> dict[str, int]:
    """Counts by flag; as many rows as the vocabulary has."""
    return {r["flag"]: r["count"] for r in records.select(F.explode("flags").alias("flag")).groupBy("flag").count().collect()}


def _rarest(totals: dict[str, int]) -> Column:
    """The count of a record's rarest flag; null without flags."""
    counts = F.create_map(*(x for f, n in totals.items() for x in (F.lit(f), F.lit(n)))) if totals else F.create_map().cast("map<string,int>")
    return F.array_min(F.transform("flags", lambda f: F.element_at(counts, f)))


def split_exact(records: DataFrame, split: str = "80/10/10") -> DataFrame:
    """(pos, split) by the sequential rule: records with the rarest flags first, each to the split that lacks its flags most.

    Every choice depends on all before it, so one task walks the records in order, but by runs: neighbours with the same flags,
    RUN at most, are one step, which says where each run starts from; the records of a run are then placed wherever the run is.
    Records without flags come last and are all alike, so that the walk is as long as the runs of the others."""
    records = written(records.select("pos", "flags"), "to-split")
    totals = _flag_totals(records)
    ordered = with_ordinals(records.select("pos", "flags", _rarest(totals).alias("rarest")).orderBy(F.asc_nulls_last("rarest"), "pos").select("pos", "flags"), "at")
    n = ordered.count()
    targets = split_targets(n, split)
    near = Window.partitionBy(F.floor(F.col("at") / RUN)).orderBy("at")
    first = F.lag("at").over(near).isNull() | ~F.col("flags").eqNullSafe(F.lag("flags").over(near))
    rows = written(ordered.withColumn("first", first).withColumn("run", F.last(F.when(F.col("first"), F.col("at")), ignorenulls=True).over(near)), "split-runs")
    starts = rows.where("first").select("run", "flags").orderBy("run").coalesce(1)

    def walk(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        splitter, open_ = GreedySplitter(targets, totals), None
        for pdf in parts:
            runs, states = [], []
            for run, flags in zip(pdf["run"], pdf["flags"], strict=True):
                if open_:
                    splitter.place_run(open_[1], run - open_[0])
                open_ = (run, list(flags) if flags is not None else [])
                runs.append(run)
                states.append([*(splitter.size[s] for s in SPLITS), *(splitter.count[s][f] for s in SPLITS for f in sorted(set(open_[1])))])
            yield pd.DataFrame({"run": runs, "state": states})

    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        splitter, at = GreedySplitter(targets, totals), None
        for pdf in parts:
            out = []
            for run, flags, state in zip(pdf["run"], pdf["flags"], pdf["state"], strict=True):
                flags = list(flags) if flags is not None else []
                if run != at:
                    at, own = run, sorted(set(flags))
                    splitter.size = dict(zip(SPLITS, map(int, state[:3]), strict=True))
                    cells = iter(map(int, state[3:]))
                    for s in SPLITS:
                        splitter.count[s].update({f: next(cells) for f in own})
                out.append(splitter.place(flags))
            yield pd.DataFrame({"pos": pdf["pos"], "split": out})

    states = written(starts.mapInPandas(walk, "run bigint, state array<bigint>"), "split-states")
    met = rows.select("pos", "flags", "at", "run").join(states, "run").repartition("run").sortWithinPartitions("run", "at")
    return met.select("pos", "flags", "run", "state").mapInPandas(place, "pos bigint, split string")


def split_by_stratum(records: DataFrame, split: str = "80/10/10", seed: int = 42) -> DataFrame:
    """(pos, stratum, split): each stratum, the rarest flag of a record (no_flag without one), is dealt to the splits by a hash, with no state between records."""
    a, b, _ = parse_split(split)
    totals = _flag_totals(records)
    ranked = sorted(totals, key=lambda f: (totals[f], f))
    stratum = F.coalesce(*(F.when(F.array_contains("flags", f), F.lit(f)) for f in ranked), F.lit("no_flag"))
    u = F.conv(F.substring(shuffled_by(seed, "pos"), 1, 6), 16, 10).cast("bigint") % 100
    return records.select("pos", stratum.alias("stratum"), F.when(u < a, "train").when(u < a + b, "eval").otherwise("test").alias("split"))


def clean_flags(records: DataFrame) -> DataFrame:
    """Flags that their text does not bear out go, with a column per rule that says so: removed_brownfield, removed_budget, removed_team, removed_onsite."""
    text = F.col("chunk_text")
    rules = (
        ("brownfield", "removed_brownfield", F.lit(True)),
        ("budget_too_low", "removed_budget", F.col("confidence").eqNullSafe("synthetic") | ~has_dollar_amount(text)),
        ("large_team", "removed_team", ~has_large_team(text)),
        ("onsite_required", "removed_onsite", ~has_onsite_term(text)),
    )
    for flag, name, gone in rules:
        records = records.withColumn(name, F.array_contains("flags", flag) & gone)
        # the first occurrence goes; labels name a flag once
        at = F.array_position("flags", flag).cast("int")
        records = records.withColumn("flags", F.when(F.col(name), F.concat(F.slice("flags", 1, at - 1), F.slice("flags", at + 1, F.size("flags")))).otherwise(F.col("flags")))
    return records


def rare_flags(records: DataFrame, vocabulary: DataFrame, threshold: int) -> DataFrame:
    """(flag, n, target) of flags below the threshold, rarest first; the target is twice the count."""
    return flag_counts(records, vocabulary).where(F.col("n") < threshold).withColumn("target", F.col("n") * 2).orderBy("n", "flag")


def flag_counts(records: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(flag, n) of every flag of the vocabulary."""
    found = records.select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))
    return vocabulary.select("flag").join(found, "flag", "left").select("flag", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def supplement(records: DataFrame, generate, needed: DataFrame, suffix: str = "") -> DataFrame:
    """Synthetic records for (flag, missing): generate(needed) gives (flag, passage, ordinal); those beyond `missing` are cut. Ordinals in ids have three digits at least, and more where they need them."""
    ordinal = F.col("ordinal").cast("string")
    made = generate(needed).join(F.broadcast(needed), "flag").where(F.col("ordinal") < F.col("missing"))
    return made.select(
        F.concat(F.lit("SYNTH-"), "flag", F.lit(suffix), F.lit("-"), F.when(F.length(ordinal) < 3, F.lpad(ordinal, 3, "0")).otherwise(ordinal)).alias("rfp_id"),
        F.lit(0).alias("chunk_index"), F.col("passage").alias("chunk_text"), F.array("flag").alias("flags"), F.lit("synthetic").alias("confidence"), F.lit(False).alias("adversarial"), F.lit("keep").alias("validation"), F.array().cast("array<string>").alias("original_flags"), F.lit(None).cast("string").alias("drop_reason"),
    )


def oversample_targets(records: DataFrame, flags: list[str], target: int, least_seeds: int = 2) -> DataFrame:
    """(flag, missing) of flags below the target that have enough clean seeds."""
    named = records.select(F.explode(F.array_distinct("flags")).alias("flag"), (~F.col("validation").eqNullSafe("dropped")).alias("ok"), (~F.col("confidence").eqNullSafe("synthetic")).alias("real")).where(F.col("flag").isin(flags))
    n = named.groupBy("flag").agg(F.count_if("ok").alias("n"), F.count_if(F.col("ok") & F.col("real")).alias("seeds"))
    return n.where((F.col("n") < target) & (F.col("seeds") >= least_seeds)).select("flag", (F.lit(target) - F.col("n")).alias("missing"))


def remaining(records: DataFrame, reserved: DataFrame, key: list[str]) -> DataFrame:
    """Records that are not reserved."""
    return records.join(reserved, key, "left_anti")
