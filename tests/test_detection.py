"""Calls in flight: bounded, in order, with one back-off a task."""

import sys
import threading
import time

import duckdb
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tamis import run_queries  # noqa: F401
from tamis.operators.detection import Backoff, Pool, ServiceDetector, detect
from tamis.queries import ORACLES, QUERIES
from tamis.schemas import Taxonomy

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE = {"now": 0}


class Slow:
    """Answers after a while, and says how many calls were under way."""

    def __init__(self, seconds=0.05):
        self.seconds, self.lock = seconds, STATE.setdefault("lock", threading.Lock())

    def detect(self, prompt):
        with self.lock:
            STATE["now"] += 1
            now = STATE["now"]
        time.sleep(self.seconds * (3 if prompt.endswith("0") else 1))
        with self.lock:
            STATE["now"] -= 1
        if prompt.endswith("7"):
            raise ValueError(f"down {prompt}")
        return f"agile_methodology, {now} {prompt}"


def asked(spark, n, in_flight, batch=None):
    if batch:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        began = time.monotonic()
        df = spark.range(0, n, 1, 1).select("id", F.concat(F.lit("p"), F.col("id").cast("string")).alias("prompt"))
        rows = detect(df, Slow, Taxonomy(), read=lambda raw: [raw], in_flight=in_flight).collect()
        return rows, time.monotonic() - began
    finally:
        if batch:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")


@pytest.mark.parametrize("batch", [7, 256])
def test_four_calls_in_flight_are_faster_bounded_and_in_order(spark, batch):
    asked(spark, 4, 4)  # workers start
    one, slow = asked(spark, 80, 1, batch)
    four, fast = asked(spark, 80, 4, batch)
    assert [(r["id"], r["prompt"]) for r in four] == [(i, f"p{i}") for i in range(80)]
    now = [int(r["flags"][0].split()[1]) for r in four if r["parsed"]]
    assert max(now) <= 4 and sum(n > 1 for n in now) > len(now) / 2
    assert {r["prompt"]: r["error"] for r in four if r["error"]} == {f"p{i}": f"ValueError: down p{i}" for i in range(7, 80, 10)}
    assert [r["parsed"] for r in one] == [r["parsed"] for r in four] and fast < slow / 2.2


def test_a_pool_keeps_batches_and_holds_few_prompts():
    import pandas as pd

    taken = []

    def batches():
        for k in range(6):
            taken.append(k)
            yield pd.Series([f"{k}-{i}" for i in range(5)])
        yield pd.Series([], dtype=str)

    pool = Pool(lambda: None, 2)
    got = []
    for out in pool.map(lambda d, p: (p,), batches()):
        got.append([p for (p,) in out])
        assert (len(taken) - len(got)) * 5 <= Pool.AHEAD * 2 + 5
    assert got == [[f"{k}-{i}" for i in range(5)] for k in range(6)] + [[]]


def test_one_refusal_holds_all_calls_of_a_task():
    clock, slept = [0.0], []

    def sleep(seconds):
        slept.append(seconds)
        clock[0] += seconds

    backoff = Backoff(lambda: clock[0], sleep)
    backoff.refused(2)
    backoff.refused(1)
    backoff.wait()
    backoff.wait()
    assert slept == [2.0]
    pool = Pool(lambda: ServiceDetector(lambda body: "{}"), 3)
    seen = []
    threads = [threading.Thread(target=lambda: seen.append(pool.detector())) for _ in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len({id(d) for d in seen}) == 3 and len({id(d.backoff) for d in seen}) == 1


def test_a_throttled_service_is_asked_again_and_other_errors_are_not():
    class Busy(Exception):
        pass

    calls = []

    def invoke(body):
        calls.append(body)
        if len(calls) < 3:
            raise Busy
        return '{"generation": "no_flag"}'

    d = ServiceDetector(invoke, is_throttled=lambda e: isinstance(e, Busy), waits=(0, 0, 0))
    assert d.detect("x") == "no_flag" and len(calls) == 3
    d = ServiceDetector(lambda body: (_ for _ in ()).throw(KeyError("x")), is_throttled=lambda e: isinstance(e, Busy), waits=(0, 0))
    with pytest.raises(KeyError):
        d.detect("x")


def test_at_least_one_call(spark):
    with pytest.raises(ValueError):
        detect(spark.range(1).select(F.lit("x").alias("prompt")), Slow, Taxonomy(), in_flight=0)


def against_sql(spark, folder, name, texts):
    """The rows of a query over documents in one partition, which are those of its SQL."""
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    df = QUERIES[name](spark, str(folder))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    got = sorted(map(tuple, df.collect()))
    assert got == sorted(con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLES[name]})").fetchall())
    return got


#: Equal texts beside each other, of each length that the detector of the queries tells apart.
EQUAL = [t for t in ("abcd", "abcde", "ab", "abc") for _ in range(3)] + ["ab", "abcdef", "ab", "ab"]


def test_equal_chunks_beside_each_other_take_as_many_attempts(spark, tmp_path):
    got = against_sql(spark, tmp_path, "q_detect_chunks", EQUAL)
    assert [r[2] for r in got] == [1] * 3 + [2] * 6 + [1] * 3 + [2] * 4


def test_equal_chunks_beside_each_other_have_one_attempt_each(spark, tmp_path):
    got = against_sql(spark, tmp_path, "q_one_attempt", EQUAL)
    assert [r[2] for r in got] == [True] * 3 + [False] * 13
