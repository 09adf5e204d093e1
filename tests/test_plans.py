from pyspark.sql import functions as F

from tamis.plans import evaluation as E
from tamis.plans import labeling as L
from tamis.plans import training_set as T
from tamis.queries import CharacterTokenizer
from tamis.schemas import RUNTIME_TIERS, Taxonomy

FLAGS = list(RUNTIME_TIERS)


def records(spark, n=60):
    rows = [(i, f"text {i % 50} about item {i % 5}", [FLAGS[i % 4], "unknown"] if i % 3 else [], "high" if i % 2 else "synthetic", i % 11 == 0, "dropped" if i % 13 == 0 else None) for i in range(n)]
    return spark.createDataFrame(rows, "pos bigint, chunk_text string, flags array<string>, confidence string, adversarial boolean, validation string")


def test_a_training_set_is_complete_and_disjoint(spark):
    for exact in (True, False):
        built = T.build(records(spark), T.TrainingSet(negative_ratio=0.5, exact_split=exact))
        seeds = {r["pos"] for r in built.seeds.collect()}
        placed = built.records.collect()
        split = {s: {r["pos"]: r["messages"] for r in d.collect()} for s, d in built.chats.items()}
        everyone = [p for d in split.values() for p in d]
        assert len(everyone) == len(set(everyone)) == len(placed) and not seeds & set(everyone)
        assert not any(p % 13 == 0 or (p >= 50 and (p - 50) % 13) for p in everyone)
        positive = sum(bool(r["flags"]) for r in placed)
        assert sum(not r["flags"] for r in placed) <= positive * 0.5 and all("unknown" not in r["flags"] for r in placed)
        some = next(iter(split["train"].values()))
        assert [m["role"] for m in some] == ["system", "user", "assistant"] and some[1]["content"].count("Example ") == 3
        assert {r["split"] for r in built.counts().collect()} == {s for s, d in split.items() if d}


def test_without_context_chunks_stay_plain(spark):
    built = T.build(records(spark), T.TrainingSet(use_context=False))
    assert built.seeds is None and all(r["messages"][1]["content"].startswith("text ") for r in built.chats["train"].collect())


def test_evaluation(spark):
    chats = spark.createDataFrame([([("system", "s"), ("user", u), ("assistant", a)],) for u, a in (("one", FLAGS[0]), ("two", "no_flag"), ("one", f"{FLAGS[0]}\n{FLAGS[1]}"))], "messages array<struct<role string, content string>>")

    class Echo:  # local, so that it travels with the plan
        def detect(self, prompt):
            return FLAGS[0] if "one" in prompt else "nothing I know"

    results = E.predict(chats, Echo, Taxonomy()).cache()
    got = E.evaluate(results)
    m = got["micro"].first()
    assert (m["n_predicted"], m["n_truth"], m["n_correct"], m["n_format_ok"]) == (2, 3, 2, 2)
    assert {r["flag"]: r["fn"] for r in got["per_flag"].collect()} == {FLAGS[0]: 0, FLAGS[1]: 1} and got["no_flag"].first()["accuracy"] == 1
    stats, advice = E.length_check(chats, CharacterTokenizer)
    assert stats.first()["count"] == 3 and advice.first()["advice"] == "1024"


def test_two_passes_and_resume(spark, tmp_path):
    class Labeller:
        def detect(self, prompt):
            if "hold for" in prompt:
                return '{"flags": ["b"]}'
            if "fail" in prompt:
                raise RuntimeError("down")
            return '```json\n{"flags": ["a", "b", "zz"]}\n```' if "alpha" in prompt else '{"flags": []}'

    packages = spark.createDataFrame([("r1", "alpha one\n\nbeta"), ("r2", " \n"), ("r3", "fail here"), ("r4", "alpha four")], "rfp_id string, text string")
    vocabulary = {"a": "first", "b": "second"}
    path = f"file://{tmp_path}/answers"
    some = L.propose(packages.where("rfp_id = 'r1'"), Labeller, vocabulary, path)
    assert [r["flags"] for r in some.collect()] == [["a", "b"]]
    n = spark.read.parquet(path).count()
    got = {r["rfp_id"]: r["flags"] for r in L.propose(packages, Labeller, vocabulary, path).collect()}
    assert got == {"r1": ["a", "b"], "r3": [], "r4": ["a", "b"]} and spark.read.parquet(path).count() == n + 2
    proposed = L.propose(packages, Labeller, vocabulary, path)
    done = {r["rfp_id"]: (r["validation"], r["flags"], r["original_flags"]) for r in L.check(proposed, Labeller, vocabulary, f"file://{tmp_path}/checks", ["a"]).collect()}
    assert done == {"r1": ("fixed", ["b"], ["a", "b"]), "r3": ("skip", [], None), "r4": ("fixed", ["b"], ["a", "b"])}
    assert [r["rfp_id"] for r in L.first_flagged(proposed, 1).collect()] == ["r1"]
    assert L.first_flagged(proposed, 5).select(F.count("*")).first()[0] == 3
