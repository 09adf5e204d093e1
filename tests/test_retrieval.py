"""Nearest passages: tiles, held stores, and the stored index, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamis.operators import retrieval as V
from tamis.operators.passage_index import PassageIndex, fit_centers, lower_bounds, straight
from tamis.operators.vectors import task_keys, unit


def brute(x, q, k, exclude=False):
    u, out = unit(x), []
    for a, row in q:
        d = np.round(1 - u @ unit(row[None])[0], 12)
        order = [int(i) for i in np.lexsort((np.arange(len(x)), d)) if not (exclude and i == a)]
        out += [(a, r + 1, i, float(d[i])) for r, i in enumerate(order[:k])]
    return out


def rows(df):
    return [(r["query_id"], r["rank"], r["id"], r["distance"]) for r in df.orderBy("query_id", "rank").collect()]


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(8, 16))[rng.integers(0, 8, 500)] + rng.normal(size=(500, 16)) / 5, rng.normal(size=(100, 16)), np.zeros((3, 16))])
    x[40:140] = x[40]  # a group of copies
    return x, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, embedding array<double>")


@pytest.mark.parametrize("held_bytes", [None, 0])
@pytest.mark.parametrize("exclude", [False, True])
def test_held_stores_and_tiles_equal_brute_force(spark, cloud, held_bytes, exclude):
    x, df = cloud
    ask = df.where("id % 9 = 4").select(F.col("id").alias("query_id"), "embedding")
    want = brute(x, [(i, x[i]) for i in range(4, len(x), 9)], 5, exclude)
    got = rows(V.top_k(ask, df, 5, exclude, block_rows=64, query_rows=16, held_bytes=held_bytes))
    assert [g[:3] for g in got] == [w[:3] for w in want] and [g[3] for g in got] == pytest.approx([w[3] for w in want], abs=1e-9)
    assert rows(V.top_k(ask, df.limit(0), 5, exclude, held_bytes=held_bytes)) == [] and rows(V.top_k(ask.limit(0), df, 5, exclude, held_bytes=held_bytes)) == []


def test_many_queries_of_a_small_store_run_in_many_tasks(spark, capsys):
    store = spark.range(14).select("id", F.array(*(F.rand(k) for k in range(8))).alias("embedding"))
    ask = spark.range(0, 200_000, 1, 16).select(F.col("id").alias("query_id"), F.array(*(F.rand(k + 8) for k in range(8))).alias("embedding"))
    hits = V.top_k(ask, store, 3)
    hits.explain()
    assert "Exchange" not in capsys.readouterr().out and hits.rdd.getNumPartitions() == 16
    assert hits.count() == 600_000


def test_tiles_have_tasks_of_their_own(spark):
    for n in (1, 7, 60):
        keys = task_keys(spark, n)
        assert sorted((r["part"], r["p"]) for r in keys.repartition(n, "key").select("part", F.spark_partition_id().alias("p")).collect()) == [(i, i) for i in range(n)]


def test_bounds_of_cells_hold():
    rng = np.random.default_rng(2)
    x, q = unit(rng.normal(size=(400, 5))), unit(rng.normal(size=(50, 5)))
    c = fit_centers(x, 12)
    d = straight(x, c)
    own = d.argmin(1)
    radius = np.array([d[own == k, k].max(initial=-np.inf) for k in range(len(c))])
    bound = lower_bounds(q, c, radius)
    for k in range(len(c)):
        if (own == k).any():
            assert (bound[:, k] <= (1 - q @ x[own == k].T).min(1) + 1e-12).all()


def as_rows(df):
    return df.select(F.col("id").alias("key"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("id"), F.lit("f").alias("flag"), F.concat(F.lit("passage "), F.col("id").cast("string")).alias("passage"), "embedding")


def test_an_index_is_exact_after_every_addition(spark, cloud, tmp_path):
    x, df = cloud
    index = PassageIndex(spark, f"file://{tmp_path}/index", block_rows=32, query_rows=8)
    ask = df.where("id % 23 = 1").select(F.col("id").alias("query_id"), "embedding")
    assert index.query_vectors(ask).count() == 0 and index.count() == 0
    for upto, cond in ((300, "id < 300"), (603, "id >= 300")):  # later passages lie outside the first radii
        index.add_vectors(as_rows(df.where(cond)))
        got = rows(index.query_vectors(ask, 6))
        want = brute(x[:upto], [(i, x[i]) for i in range(1, len(x), 23)], 6)
        assert [g[:3] for g in got] == [w[:3] for w in want] and index.count() == upto
    probes = index.probes_for(ask, 6, 0.9)
    few = rows(index.query_vectors(ask, 6, probes))
    hit = {g[:1] + g[2:3] for g in few} & {w[:1] + w[2:3] for w in want}
    assert len(hit) >= 0.9 * len(want) and probes < len(index._centers())
    assert len(rows(index.query_vectors(ask.limit(1), 1000))) == len(x)  # more than the first cells hold


def test_a_search_reads_fewer_cells_than_there_are(spark, cloud, tmp_path, monkeypatch):
    _, df = cloud
    index = PassageIndex(spark, f"file://{tmp_path}/index", cells=24)
    index.add_vectors(as_rows(df))
    asked, search = [], PassageIndex._search

    def counted(self, q, centers, radius, k, probes, beyond=False):
        from tamis.operators import passage_index as P

        was = P.written
        monkeypatch.setattr(P, "written", lambda d, name: (out := was(d, name), asked.append(out.count()) if name == "index-probes" else None)[0])
        out = search(self, q, centers, radius, k, probes, beyond)
        monkeypatch.setattr(P, "written", was)
        return out

    monkeypatch.setattr(PassageIndex, "_search", counted)
    queries = df.where("id % 20 = 3 AND id < 500").select(F.col("id").alias("query_id"), "embedding")
    index.query_vectors(queries, 3).collect()
    assert sum(asked) < 0.7 * 24 * queries.count()


def test_an_index_of_texts(spark, tmp_path):
    index = PassageIndex(spark, f"file://{tmp_path}/texts")
    passages = spark.createDataFrame([(0, "a", "red apples and pears"), (1, "b", "the moon at night"), (2, "a", "apples in a basket"), (3, "c", "software in sprints")], "pos bigint, flag string, passage string")
    ask = spark.createDataFrame([(1, "apples in a basket")], "query_id bigint, text string")
    assert index.query(ask).count() == 0
    assert (index.add(passages), index.add(passages), index.count()) == (4, 0, 4)
    hits = index.query(ask, 2).first()["hits"]
    assert len(hits) == 2 and hits[0]["passage"] == "apples in a basket" and hits[0]["flag"] == "a" and hits[0]["distance"] < 1e-9
    assert {r["id"] for r in index.passages().collect()} == {"a_0", "b_0", "a_1", "c_0"}
