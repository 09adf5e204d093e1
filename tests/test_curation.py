import random

import pytest
from pyspark.sql import functions as F

from tamis.operators import curation as C
from tamis.operators import labeling as L
from tamis.operators import metrics as M
from tamis.operators.sampling import sample_exactly
from tamis.schemas import literals

SCHEMA = "pos bigint, chunk_text string, flags array<string>, confidence string, adversarial boolean, validation string"


def make(spark, n, seed, flags="abcde"):
    rng = random.Random(seed)
    rows = [(i, f"t{rng.randint(0, n)}", rng.sample(flags, rng.choice([0, 1, 1, 2, 3])), rng.choice(["high", "medium", "synthetic"]), rng.random() < 0.1, rng.choice([None, "keep", "dropped"])) for i in range(n)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3)


def positions(df):
    return sorted(r["pos"] for r in df.select("pos").collect())


def test_first_of_each_text_stays(spark):
    rows, df = make(spark, 200, 1)
    first = {}
    for r in rows:
        first.setdefault(r[1], r[0])
    assert positions(C.dedup_first(df)) == sorted(first.values())
    assert positions(C.dedup_first(C.dedup_first(df))) == sorted(first.values())


@pytest.mark.parametrize("per_flag", [0, 1, 2, 5])
def test_seeds_are_reserved_once(spark, per_flag):
    rows, df = make(spark, 60, 2)
    order = []
    for r in rows:
        order += [] if r[4] else [f for f in r[2] if f not in order]
    taken = {}
    for flag in order:
        key = lambda r: ({"high": 0, "medium": 1, "synthetic": 2}[r[3]], r[0])
        free = [r[0] for r in sorted((r for r in rows if not r[4] and flag in r[2]), key=key) if r[0] not in taken]
        taken |= dict.fromkeys(free[: max(1, per_flag)], flag)
    seeds, left = C.select_seeds(df, per_flag, list("abcde"))
    assert {r["pos"]: r["flag"] for r in seeds.collect()} == taken
    assert positions(left) == [r[0] for r in rows if r[0] not in taken]


def test_caps_are_exact(spark):
    rows, df = make(spark, 300, 3)
    positive = [r for r in rows if r[2]]
    for ratio in (0.1, 0.25, 5):
        got = C.cap_negatives(df, ratio).collect()
        assert sum(bool(r["flags"]) for r in got) == len(positive)
        assert sum(not r["flags"] for r in got) == min(len(rows) - len(positive), int(len(positive) * ratio))
    assert positions(C.cap_flags(df, {})) == [r[0] for r in rows]
    kept = C.cap_flags(df, {"a": 10, "b": 5}).collect()
    n = lambda f, rs: sum(f in r for r in rs)
    assert n("a", [r["flags"] for r in kept]) <= 10 and n("b", [r["flags"] for r in kept]) <= 5
    assert sum(not {"a", "b"} & set(r["flags"]) for r in kept) == sum(not {"a", "b"} & set(r[2]) for r in rows)
    assert positions(C.cap_flags(df, {"a": 1000})) == [r[0] for r in rows]


def test_samples_are_exact_and_repeatable(spark):
    df = spark.range(1000).withColumnRenamed("id", "pos")
    a = positions(sample_exactly(df, 137, 5, "pos"))
    assert len(set(a)) == 137 and a == positions(sample_exactly(df.repartition(7), 137, 5, "pos")) and a != positions(sample_exactly(df, 137, 6, "pos"))
    assert len(positions(sample_exactly(df, 5000, 5, "pos"))) == 1000 and positions(sample_exactly(df, 0, 5, "pos")) == []


def model_split(rows, split):
    a, e, t = map(int, split.split("/"))
    n = len(rows)
    target = {"train": 0, "eval": int(n * e / 100), "test": int(n * t / 100)}
    target["train"] = n - target["eval"] - target["test"]
    total = {f: sum(f in r[2] for r in rows) for f in "abcde"}
    put, out = {s: [] for s in target}, {}
    for r in sorted(rows, key=lambda r: min([total[f] for f in r[2]], default=999999)):
        scores = [(max(sum(f in x for x in put[s]) / max(total[f] * target[s] / n, 1) for f in r[2]), k, s) for k, s in enumerate(target) if len(put[s]) < target[s]] if r[2] else []
        s = min(scores)[2] if scores else max(target, key=lambda s: target[s] - len(put[s]))
        put[s].append(r[2])
        out[r[0]] = s
    return out


@pytest.mark.parametrize("split", ["80/10/10", "50/25/25"])
def test_exact_split(spark, split):
    rows, df = make(spark, 150, 4)
    assert {r["pos"]: r["split"] for r in C.split_exact(df, split).collect()} == model_split(rows, split)


def test_split_by_stratum_covers_everything(spark):
    rows, df = make(spark, 500, 5)
    got = C.split_by_stratum(df).collect()
    assert sorted(r["pos"] for r in got) == [r[0] for r in rows]
    assert 0.7 < sum(r["split"] == "train" for r in got) / 500 < 0.9
    for bad in ("80/10", "80/10/20", "a/b/c"):
        with pytest.raises(ValueError):
            C.parse_split(bad)


def test_cleaning_rules(spark):
    rows = [
        (0, "$ 5 per 12 FTE", ["brownfield", "budget_too_low", "large_team", "x"], "high"),
        (1, "$ 5", ["budget_too_low"], "synthetic"),
        (2, "no amount", ["budget_too_low", "large_team", "onsite_required"], None),
        (3, "work on site", ["onsite_required"], "high"),
        (4, "nothing", [], "high"),
    ]
    got = C.clean_flags(spark.createDataFrame(rows, "pos bigint, chunk_text string, flags array<string>, confidence string")).orderBy("pos").collect()
    assert [r["flags"] for r in got] == [["budget_too_low", "large_team", "x"], [], [], ["onsite_required"], []]
    assert [r["removed_budget"] for r in got] == [False, True, True, False, False]


def test_verdicts(spark):
    df = spark.createDataFrame([(i, ["a", "b"]) for i in range(6)], "pos bigint, flags array<string>")
    v = [(0, 0, 0, "fix", ["c", "zz"], None), (0, 1, 0, "DROP", [], "bad"), (0, 2, 0, "drop", [], "x"), (0, 2, 1, "KEEP", [], None), (0, 3, 0, "what", [], None), (1, 0, 0, "FIX", None, None)]
    got = L.apply_verdicts(df, spark.createDataFrame(v, "batch_id bigint, index int, seq int, verdict string, corrected_flags array<string>, reason string"), literals(["a", "b", "c"]), 4).orderBy("pos").collect()
    assert [r["validation"] for r in got] == ["fixed", "dropped", "keep", "keep", "fixed", "keep"]
    assert [r["flags"] for r in got] == [["c"], ["a", "b"], ["a", "b"], ["a", "b"], [], ["a", "b"]]
    assert [r["drop_reason"] for r in got] == [None, "bad", None, None, None, None] and all(r["original_flags"] == ["a", "b"] for r in got)


def test_revalidation(spark):
    df = spark.createDataFrame([(0, []), (1, ["a", "b"]), (2, ["a", "b"]), (3, ["a"])], "pos bigint, flags array<string>")
    answers = spark.createDataFrame([(1, ["b", "a", "zz"]), (2, ["a", "c"])], "pos bigint, answered array<string>")
    got = {r["pos"]: (r["validation"], r["flags"], r["original_flags"]) for r in L.revalidate(df, answers, literals(["a", "b", "c"]), ["pos"]).collect()}
    assert got == {0: ("skip", [], None), 1: ("keep", ["a", "b"], None), 2: ("fixed", ["a"], ["a", "b"]), 3: ("fixed", [], ["a"])}


def test_resume_and_stop(spark):
    work = spark.createDataFrame([(i, f"t{i % 4}", i % 3 == 0) for i in range(12)], "seq bigint, text string, flagged boolean")
    done = work.where("seq < 5")
    assert [r["seq"] for r in L.not_done(work, done, ["seq"]).orderBy("seq").collect()] == list(range(5, 12))
    assert L.not_done_by_text(work, work.where("seq < 2")).count() == 6
    assert L.after_position(work, 7, "seq").count() == 5
    assert [r["seq"] for r in L.stop_after_flagged(work, 2).orderBy("seq").collect()] == [0, 1, 2, 3]
    assert L.stop_after_flagged(work, 100).count() == 12


def test_quotas(spark):
    rows = [(i, i // 3, "ab"[i % 2]) for i in range(18)]
    found = spark.createDataFrame(rows, "seq bigint, rfp_id bigint, flag string")
    status = {r["flag"]: (r["n"], r["filled"]) for r in L.quota_status(found, spark.createDataFrame([("a", 9), ("b", 10), ("c", 1)], "flag string, target bigint")).collect()}
    assert status == {"a": (9, True), "b": (9, False), "c": (0, False)}
    want, count = [], {"a": 0, "b": 0}
    for rfp in range(6):
        own = [r for r in rows if r[1] == rfp]
        taken = [r for r in own if count[r[2]] < 4]
        for r in taken:
            count[r[2]] += 1
        want += [r[0] for r in taken]
    assert sorted(r["seq"] for r in L.quota_gated(found, 4).collect()) == want


def results(spark, rows):
    return spark.createDataFrame(rows, "predicted array<string>, ground_truth array<string>, format_ok boolean")


def test_metrics(spark):
    m = lambda rows: M.micro_metrics(results(spark, rows)).first()
    r = m([(["a"], ["a"], True), ([], [], True)])
    assert (r["precision"], r["recall"], r["f1"], r["format_compliance"]) == (1, 1, 1, 1)
    r = m([(["a"], ["b"], True)])
    assert (r["precision"], r["recall"], r["f1"]) == (0, 0, 0)
    r = m([(["a", "b", "a"], ["a", "c"], True), ([], [], False), (["a"], ["a"], True)])
    assert (r["n_predicted"], r["n_truth"], r["n_correct"]) == (3, 3, 2) and r["format_compliance"] == pytest.approx(2 / 3)
    r = m([])
    assert (r["n_results"], r["precision"], r["recall"], r["format_compliance"]) == (0, 1, 1, 0)
    per = {x["flag"]: (x["tp"], x["fp"], x["fn"]) for x in M.per_flag_metrics(results(spark, [(["a", "b"], ["a", "c"], True)])).collect()}
    assert per == {"a": (1, 0, 0), "b": (0, 1, 0), "c": (0, 0, 1)}
    assert M.no_flag_accuracy(results(spark, [(["a"], [], True), ([], [], True)])).first()["accuracy"] == 0.5
    assert M.no_flag_accuracy(results(spark, [(["a"], ["a"], True)])).count() == 0
    deltas = {x["metric"]: x["sign"] for x in M.compare_models(M.micro_metrics(results(spark, [(["a"], ["b"], True)])), M.micro_metrics(results(spark, [(["a"], ["a"], True)]))).collect()}
    assert deltas == {"precision": "+", "recall": "+", "f1": "+", "format_compliance": ""}


@pytest.mark.parametrize("values", [list(range(1, 101)), [100, 200, 300, 400, 500], [42], [1, 1, 2, 9, 9, 9]])
def test_length_stats(spark, values):
    r = M.length_stats(spark.createDataFrame([(v,) for v in values], "n bigint").repartition(3)).first()
    s, n = sorted(values), len(values)
    at = lambda q: s[min(int(n * q), n - 1)]
    assert (r["count"], r["min"], r["max"], r["p95"], r["p99"]) == (n, s[0], s[-1], at(0.95), at(0.99))
    assert r["mean"] == pytest.approx(sum(s) / n) and r["median"] == (s[(n - 1) // 2] + s[n // 2]) / 2


def test_histogram_diff_and_targets(spark):
    rows, df = make(spark, 100, 6)
    want = {f: sum(f in r[2] for r in rows) for f in "abcde"} | {"no_flag": sum(not r[2] for r in rows)}
    got = M.flag_histogram(df).collect()
    assert {r["flag"]: r["n"] for r in got} == want and [r["n"] for r in got] == sorted(want.values(), reverse=True)
    vocabulary = spark.createDataFrame([(f,) for f in "abcdez"], "flag string")
    rare = C.rare_flags(df, vocabulary, 25).collect()
    assert rare[0]["flag"] == "z" and all(r["target"] == 2 * r["n"] for r in rare)
    fixed = spark.createDataFrame([(["a", "b"], ["b", "c"], "fixed"), (["a"], ["b"], "keep")], "flags array<string>, original_flags array<string>, validation string")
    assert {r["flag"]: (r["added"], r["removed"]) for r in M.flag_diff(fixed).collect()} == {"a": (1, 0), "c": (0, 1)}
    missing = {r["flag"]: r["missing"] for r in C.oversample_targets(df, ["a", "b"], 50).collect()}
    ok = [r for r in rows if r[5] != "dropped"]
    assert missing["a"] == 50 - sum("a" in r[2] for r in ok)
    made = C.supplement(df, lambda need: need.select("flag", F.explode(F.sequence(F.lit(0), F.lit(99))).alias("ordinal"), F.lit("p").alias("passage")), spark.createDataFrame([("a", 3)], "flag string, missing bigint")).collect()
    assert sorted(r["rfp_id"] for r in made) == ["SYNTH-a-000", "SYNTH-a-001", "SYNTH-a-002"]
    assert M.training_steps(493, 2, 8, 5, 0.1) == (150, 15)


def test_ids_of_many_supplements_differ(spark):
    needed = spark.createDataFrame([("a", 1200)], "flag string, missing int")
    made = lambda n: n.select("flag", F.explode(F.sequence(F.lit(0), F.col("missing") + 3)).alias("ordinal")).withColumn("passage", F.lit("x"))
    ids = [r["rfp_id"] for r in C.supplement(None, made, needed, "-v2").collect()]
    assert len(ids) == len(set(ids)) == 1200 and {"SYNTH-a-v2-000", "SYNTH-a-v2-099", "SYNTH-a-v2-999", "SYNTH-a-v2-1000", "SYNTH-a-v2-1199"} <= set(ids)


def test_runs_are_placed_like_single_records():
    rng = random.Random(3)
    for _ in range(60):
        kinds = [[], ["a"], ["a", "b"], ["b", "c", "c"], ["d"]]
        runs = [(rng.choice(kinds), rng.choice([1, 2, 65, 200, 700])) for _ in range(8)]
        rest = sum(n for _, n in runs)
        runs.append(([], rng.randrange(1, 300)))
        n = rest + runs[-1][1]
        totals = {f: sum(k.count(f) * m for k, m in runs) for f in "abcd"}
        totals = {f: m for f, m in totals.items() if m}
        targets = C.split_targets(n, rng.choice(["80/10/10", "34/33/33", "100/0/0", "0/50/50"]))
        slow, fast = C.GreedySplitter(targets, totals), C.GreedySplitter(targets, totals)
        for flags, length in runs:
            for _ in range(length):
                slow.place(flags)
            fast.place_run(flags, length)
            assert (fast.size, fast.count) == (slow.size, slow.count)


def test_exact_split_of_long_runs(spark, monkeypatch):
    monkeypatch.setattr(C, "RUN", 100)
    flags = [[], ["a"], ["b"], ["a", "b"]]
    rows = [(i, f"t{i}", flags[(i // 130) % 4 if i < 1000 else 0]) for i in range(1500)]
    df = spark.createDataFrame([(i, f) for i, _, f in rows], "pos bigint, flags array<string>")
    assert {r["pos"]: r["split"] for r in C.split_exact(df, "70/20/10").collect()} == model_split(rows, "70/20/10")
    assert C.split_exact(df.limit(0)).count() == 0


def test_a_run_costs_few_steps(monkeypatch):
    calls = []
    fill = C.GreedySplitter.fill
    monkeypatch.setattr(C.GreedySplitter, "fill", lambda self, *a: calls.append(1) or fill(self, *a))
    splitter = C.GreedySplitter(C.split_targets(10_000_000, "80/10/10"), {"a": 10_000_000})
    splitter.place_run(["a"], 9_000_000)
    assert sum(splitter.size.values()) == 9_000_000 and len(calls) < 20_000
