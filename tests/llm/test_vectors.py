import numpy as np
import pytest
from pyspark.sql import functions as F

from tamis.llm.common import components, join_small, local_roots, stash
from tamis.llm.embedding_dedup import embedding_near_duplicates
from tamis.llm.topk_search import ImpactIndex, topk_search

BAD = [(1000, None, 0), (1001, [float("nan")] * 8, 0), (1002, [1.0, None] + [0.0] * 6, 0), (1003, [float("inf")] + [0.0] * 7, 0)]


def vectors(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    return df.withColumn("score", F.lit("x")).withColumn("rank", F.lit(1)).withColumn("rep", F.lit(2)) if extra else df


def cloud(n, d, seed, groups=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) / np.sqrt(d)
    for k in range(n // 3):
        x[n - 1 - k] = x[k % 7] + rng.normal(size=d) * 0.02 / np.sqrt(d) * (1 + k % 9)
    x[5] = x[4]
    return [(i, x[i].astype(np.float32).tolist(), int(i % groups)) for i in range(n)]


def brute_topk(rows, k, every):
    good = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for i, v, _ in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for q, a in good:
        if q % every == 0:
            best = sorted((-int(a @ b), i) for i, b in good if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("block", [16, 8192])
def test_topk_equals_brute_force(spark, block):
    rows = cloud(300, 8, 1) + BAD
    df = vectors(spark, rows, extra=True).repartition(3)
    got = topk_search(df, df.where("vec_id % 7 = 0"), 5, block_rows=block, query_rows=10)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute_topk(rows, 5, 7)


def test_topk_of_ties_repeats_and_few(spark):
    rows = [(i, [1.0, 0.0], 0) for i in range(9)]
    df = vectors(spark, rows)
    assert [r["vec_id"] for r in topk_search(df, df.where("vec_id = 3"), 4).orderBy("rank").collect()] == [0, 1, 2, 4]
    few = vectors(spark, rows[:3])
    assert topk_search(few, few.where("vec_id = 0"), 5).count() == 2
    twice = vectors(spark, [*rows[:2], rows[1]])
    got = topk_search(twice, twice, 5).groupBy("query_id").count().collect()
    assert {r["query_id"]: r["count"] for r in got} == {0: 2, 1: 1}
    none = vectors(spark, [])
    assert topk_search(none, none, 5).count() == 0 and topk_search(few, none, 5).count() == 0
    bad = vectors(spark, BAD)
    assert topk_search(bad, bad, 5).count() == 0


def test_shorter_vectors_are_padded_and_zeros_score_nothing(spark):
    df = vectors(spark, [(0, [1.0, 1.0], 0), (1, [1.0], 0), (2, [0.0, 0.0], 0), (3, [], 0), (4, [-1.0, 1.0, 5.0], 0)])
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in topk_search(df, df, 5).collect()}
    assert got[0, 1] == 65536 and got[0, 4] == 0 and got[1, 4] == -65536 and got[3, 0] == 0 and got[2, 0] == 0


def test_the_index_rescores_exactly_for_huge_values():
    cells = np.array([[2**20, -(2**20)], [2**20 - 1, -(2**20)], [3, 4]])
    scores, ids = ImpactIndex(np.arange(3), cells).search(-1, np.array([2**20, -(2**20)]), 2)
    assert ids.tolist() == [0, 1] and scores.tolist() == [2**41, 2**41 - 2**20]


def brute_links(rows, t=0.98):
    ok = [(i, np.array(v, np.float32).astype(float), a) for i, v, a in rows if v and a is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    n, up = {}, {r[0]: r[0] for r in rows}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for k, (i, x, a) in enumerate(ok):
        for j, y, b in ok[:k]:
            if a == b and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= t:
                n[i], n[j] = n.get(i, 0) + 1, n.get(j, 0) + 1
                p, q = find(i), find(j)
                up[max(p, q)] = min(p, q)
    return {r[0]: (n.get(r[0], 0), find(r[0]), find(r[0]) == r[0]) for r in rows}


@pytest.mark.parametrize("cell", [2048, 8])
def test_near_duplicates_equal_brute_force(spark, cell, monkeypatch):
    import tamis.llm.embedding_dedup as E

    monkeypatch.setattr(E, "CELL_ROWS", cell)
    rows = cloud(260, 16, 2, 3) + [(i, None if v is None else v, a) for i, v, a in BAD] + [(2000, [0.0] * 16, 0), (2001, [1.0] * 16, None), (2002, [1.0] * 16, None), (2003, [1.0] * 16, 1), (2004, [2.0] * 16, 1), (2005, [1.0], 1), (2006, [], 1)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_near_duplicates(vectors(spark, rows, extra=True).repartition(3)).collect()}
    want = brute_links(rows)
    assert sum(v[0] for v in want.values()) > 100
    assert got == want


def test_copies_repeated_ids_and_nothing(spark):
    rows = [(i, [0.5, 0.5], 1) for i in (9, 3, 7)] + [(3, [0.5, 0.5], 1)]
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embedding_near_duplicates(vectors(spark, rows)).collect())
    assert got == [(3, 3, 3, True), (3, 3, 3, True), (7, 3, 3, False), (9, 3, 3, False)]
    assert embedding_near_duplicates(vectors(spark, [])).count() == 0


def test_components_of_chains_stars_and_singles(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(500, 500), (130, 129), (700, 650)]
    got = {r["node"]: r["component_id"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[100 + k] for k in range(31)} == {100} and got[700] == 650 and 500 not in got
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
    assert local_roots(5, np.array([4, 2]), np.array([3, 4])).tolist() == [0, 1, 2, 2, 2]


def test_the_salted_join_equals_the_broadcast_one(spark, monkeypatch):
    import tamis.llm.common as C

    big = spark.createDataFrame([(i, "hot" if i % 3 else "k") for i in range(90)], "i int, k string")
    small = stash(spark.createDataFrame([("hot", 1), ("x", 2)], "k string, v int"), "small")
    for how in ("left", "inner", "left_anti", "left_semi"):
        a = sorted(map(str, join_small(big, small, ["k"], F.col("i"), how).collect()))
        monkeypatch.setattr(C, "BROADCAST_BYTES", -1)
        assert a == sorted(map(str, join_small(big, small, ["k"], F.col("i"), how).select(*join_small(big, small, ["k"], F.col("i"), how).columns).collect()))
        monkeypatch.undo()


def test_repeated_ids_with_other_vectors_and_labels(spark):
    rows = [(3, [1.0, 0.01], 1), (5, [1.0, 0.0], 1), (5, [0.0, 1.0], 2), (8, [0.0, 1.0], 2)]
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_near_duplicates(vectors(spark, rows)).collect())
    assert got == [(3, 1, 3), (5, 1, 3), (5, 1, 5), (8, 1, 5)]


@pytest.mark.parametrize("cost", [1, 4])
def test_tables_of_large_labels_find_the_links_of_brute_force(spark, cost, monkeypatch):
    import tamis.llm.embedding_dedup as E

    monkeypatch.setattr(E, "ROW_COST", cost)
    E.layout.cache_clear()
    rows = cloud(400, 16, 2, 5)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_near_duplicates(vectors(spark, rows).repartition(3)).collect()}
    assert E.layout(200, 0.98)[0] >= 3 and got == brute_links(rows)
    E.layout.cache_clear()


def test_estimates_are_unbiased_and_bounds_hold():
    from tamis.llm.embedding_dedup import Codes, estimates, unit_rows

    rng = np.random.default_rng(4)
    unit = unit_rows(rng.normal(size=(400, 64)) + 0.6 * rng.normal(size=64))
    off, whole = ~np.eye(400, dtype=bool), unit @ unit.T
    gaps = [(estimates(Codes(unit, rng, part)) - whole)[off] for part in range(24)]
    assert max(g.std() for g in gaps) < 0.11 and abs(np.mean(gaps)) < 2e-3
    assert abs(np.mean(gaps, axis=0)).max() < 6 * 0.11 / 24**0.5  # pair by pair, over the rotations
    assert (Codes(unit, rng).bounds(slice(0, 400), slice(0, 400)) >= whole).mean() > 0.9999


def test_the_walk_proves_and_stops(spark):
    rng = np.random.default_rng(8)
    cells = np.floor(256 * rng.normal(size=(8192, 64)) / 8).astype(np.int64)
    index = ImpactIndex(np.arange(8192), cells)
    for own in range(0, 400, 50):
        scores, ids = index.search(own, cells[own], 5)
        all_ = cells @ cells[own]
        all_[own] = -(2**40)
        want = np.lexsort((np.arange(8192), -all_))[:5]
        assert ids.tolist() == want.tolist() and scores.tolist() == all_[want].tolist()
    assert index.read + index.rescored < 0.72 * 8 * cells.size


def test_task_keys_reach_their_partitions(spark):
    from tamis.llm.topk_search import task_keys

    keys = task_keys(spark, 21)
    got = keys.repartition(21, "key").selectExpr("part", "spark_partition_id() AS p").collect()
    assert len(got) == 21 and all(r["part"] == r["p"] for r in got)
