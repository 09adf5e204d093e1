import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tamis.streaming.quotas import count_quotas, gate_quotas, label_until, quotas_filled, write_gated

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_counts_resume_from_the_checkpoint(spark, tmp_path):
    src, out, mark = (f"file://{tmp_path}/{x}" for x in ("src", "out", "mark"))
    batch = lambda n: spark.createDataFrame([("a",)] * n + [("b",)], "flag string").coalesce(1).write.mode("append").parquet(src)
    counts = lambda: {r["flag"]: r["n"] for r in spark.read.parquet(out).collect()}
    stream = lambda: spark.readStream.schema("flag string").parquet(src)
    batch(3)
    count_quotas(stream(), out, mark)
    assert counts() == {"a": 3, "b": 1}
    batch(2)
    count_quotas(stream(), out, mark)
    assert counts() == {"a": 5, "b": 2}
    count_quotas(stream(), out, mark)
    assert counts() == {"a": 5, "b": 2}


def append(spark, src, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)


def model(batches, targets):
    """Rows taken, by the rule, batch after batch."""
    n, let_in, out = {}, {}, []
    for batch in batches:
        for flag in sorted({r[0] for r in batch if r[0]}):
            own = sorted((r for r in batch if r[0] == flag and r[1] is not None), key=lambda r: (r[1], r[2]))
            for package in dict.fromkeys(r[1] for r in own):
                known = let_in.setdefault(flag, set())
                if flag not in targets or package in known or n.get(flag, 0) < targets[flag]:
                    known.add(package)
                    some = [r for r in own if r[1] == package]
                    n[flag] = n.get(flag, 0) + len(some)
                    out += some
    return sorted(out), n


@pytest.mark.parametrize("restarts", [False, True])
def test_quotas_are_state(spark, tmp_path, restarts):
    src, out, mark = (f"file://{tmp_path}/{x}" for x in ("src", "out", "mark"))
    schema = "flag string, rfp_id string, seq bigint"
    batches = [
        [("a", "p1", 1), ("a", "p1", 2), ("b", "p1", 3), (None, "p1", 4), ("c", "p1", 5)],
        [("a", "p2", 6), ("a", "p2", 7), ("a", "p3", 8), ("b", None, 9), ("c", "p3", 10)],  # p2 overshoots a's target of 3
        [("a", "p2", 11), ("a", "p4", 12), ("b", "p4", 13), ("b", "p5", 14)],  # p2 goes on, p4 is not let in for a
        [("a", "p2", 15), ("a", "p5", 16), ("b", "p6", 17), ("c", "p9", 18)],
    ]
    targets = {"a": 3, "b": 2}
    run = lambda: write_gated(gate_quotas(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src), targets), out, mark)
    for rows in batches:
        append(spark, src, rows, schema)
        if restarts:
            run()
    run()
    got = spark.read.parquet(out).collect()
    want, n = model(batches, targets)
    assert sorted((r["flag"], r["rfp_id"], r["seq"]) for r in got) == want
    assert n == {"a": 6, "b": 3, "c": 3} or n["a"] == 6
    last = {f: max(r["taken"] for r in got if r["flag"] == f) for f in n}
    assert last == n and len({r["rfp_id"] for r in got if r["flag"] == "a"}) == 2


def test_labelling_stops_when_done_and_skips_what_is_written(spark, tmp_path):
    src, out, mark = (f"file://{tmp_path}/{x}" for x in ("src", "out", "mark"))
    for ids in ([1, 2], [2, 3], [4, 5], [6]):
        append(spark, src, [(i,) for i in ids], "id bigint")
    stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(src)
    n = label_until(stream, lambda b: b.withColumn("flag", F.lit("x")), out, mark, ["id"], lambda t: t.agg(F.sum("n")).first()[0] >= 4)
    ids = sorted(r["id"] for r in spark.read.parquet(out).collect())
    assert len(ids) == len(set(ids)) and 4 <= len(ids) < 6 and n < 4


def test_a_batch_that_was_written_is_not_labelled_again(spark, tmp_path):
    src, out, mark = (f"file://{tmp_path}/{x}" for x in ("src", "out", "mark"))
    append(spark, src, [(1,), (2,), (9,)], "id bigint")
    asked, broken = [], [True]
    summary, done = quotas_filled({"x": 3, "no_flag": 2})

    def label(batch):
        asked.append(sorted(r["id"] for r in batch.collect()))
        return batch.withColumn("flags", F.when(F.col("id") < 6, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>")))

    def breaking(rows):
        if broken[0]:
            raise RuntimeError("the run ends after its batch was written")
        return summary(rows)

    run = lambda: label_until(spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(src), label, out, mark, ["id"], done, breaking, spark.createDataFrame([(9,)], "id bigint"))
    with pytest.raises(Exception):
        run()
    broken[0] = False
    assert run() == 1 and asked == [[1, 2]]
    for ids in ([2, 3], [7], [8], [4, 5], [6]):
        append(spark, src, [(i,) for i in ids], "id bigint")
    run()
    assert asked == [[1, 2], [3], [7], [8]]  # x has 3 and no_flag 2
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3, 7, 8]
