"""Sharding, clustering and the Merkle manifest against plain versions."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamis.llm import clustering, merkle, sharding
from tamis.llm.clustering import Yinyang, cluster_vectors, group_centroids, squared
from tamis.llm.merkle import merkle_manifest, siblings
from tamis.llm.sharding import shard_records, write_shards

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# --- sharding ----------------------------------------------------------------------------------------------------------


def slow_bids(key, weights):
    u = [(int(hashlib.md5(f"{key}:{s}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52 for s in range(len(weights))]
    return [-np.log(x) / w if w else np.inf for x, w in zip(u, weights, strict=True)]


@pytest.fixture(scope="module")
def odd_docs(spark):
    rows = [(i, "é" * (i % 7) + f" text {i % 40}", "en", f"s{i % 3}", i) for i in range(300)]
    rows += [(7, "hot", None, "s1", 3)] * 200 + [(7, f"other {i}", None, None, 3) for i in range(50)] + [(None, None, None, None, None)] * 3 + [(400, "", "de", "", 0), (401, None, "de", "", 0), (402, "x" * 100_000, "de", "é", 1)]
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("cell,run", [(1 << 16, 1 << 16), (16, 8)])
@pytest.mark.parametrize("weights", [[1.0] * 8, [1.0, 0.0, 2.5, 0.5]])
def test_shards_slots_and_checksums(spark, odd_docs, weights, cell, run, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", cell)
    monkeypatch.setattr(sharding, "RUN", run)
    got = shard_records(odd_docs, weights, grown=1.5).collect()
    rows = odd_docs.collect()
    facts = lambda r: (r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode()))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(map(facts, rows))
    for r in got:
        key = "-" if r["doc_id"] is None else r["doc_id"]
        assert r["shard"] == int(np.argmin(slow_bids(key, weights))) and r["law"] == "key"
        assert r["grown_shard"] == int(np.argmin(slow_bids(key, [*weights, 1.5]))) and r["grown_shard"] in (r["shard"], len(weights))
    for shard in {r["shard"] for r in got}:
        own = sorted((r for r in got if r["shard"] == shard), key=lambda r: r["slot"])
        assert [r["slot"] for r in own] == list(range(len(own)))
        place = [hashlib.md5(f"{'-' if r['doc_id'] is None else r['doc_id']}:{r['size']}:{r['text_crc32']}".encode()).hexdigest() for r in own]
        assert place == sorted(place)
    assert sorted(map(repr, got)) == sorted(map(repr, shard_records(odd_docs.repartition(7), weights, grown=1.5).collect()))


def test_shares_follow_weights_and_few_records_move(spark):
    ids = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    got = shard_records(ids, [1.0, 2.0, 1.0], grown=1.0).toPandas()
    share = got["shard"].value_counts(normalize=True).sort_index().tolist()
    assert share == pytest.approx([0.25, 0.5, 0.25], abs=0.02)
    moved = got[got["shard"] != got["grown_shard"]]
    assert set(moved["grown_shard"]) == {3} and len(moved) / len(got) == pytest.approx(0.2, abs=0.02)
    assert shard_records(ids, [1.0, 1.0], grown=None).where("grown_shard IS NOT NULL").count() == 0


def test_sharding_of_nothing_and_bad_weights(spark, odd_docs):
    assert shard_records(odd_docs.limit(0), [1.0, 1.0]).count() == 0
    for weights in ([], [0.0], [-1.0, 2.0], [float("inf")]):
        with pytest.raises(ValueError):
            shard_records(odd_docs, weights)


def test_written_shards_hold_all_rows(spark, odd_docs, tmp_path):
    path = f"file://{tmp_path}/shards"
    write_shards(odd_docs.withColumn("_shard", F.lit("kept")), path, [1.0] * 4)
    back = spark.read.schema(f"{DOCS}, _shard string, shard int").parquet(path)
    assert Counter(map(tuple, back.select(*odd_docs.columns).collect())) == Counter(map(tuple, odd_docs.collect()))
    want = {r["doc_id"]: r["shard"] for r in shard_records(odd_docs, [1.0] * 4).collect()}
    assert all(r["shard"] == want[r["doc_id"]] and r["_shard"] == "kept" for r in back.collect())


def test_sharding_is_native_and_no_shard_is_sorted_whole(spark, odd_docs, capsys):
    shard_records(odd_docs, [1.0] * 8).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "SinglePartition" not in plan


# --- clustering --------------------------------------------------------------------------------------------------------


def slow_clusters(rows, k, rounds, dims, scale):
    kept = [(i, np.floor(np.array(v, np.float64) * scale).astype(int)) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, sha(f"1:{r[0]}"), r[1].tolist()))
    c = [v.tolist() for _, v in order[:k]]
    x = np.array([v for _, v in kept])
    for r in range(rounds + 1):
        d = np.stack([((x - np.array(row)) ** 2).sum(1) for row in c], axis=1)
        own = d.argmin(1)
        if r < rounds:
            c = [[int(s) // int((own == j).sum()) for s in x[own == j].sum(0)] if (own == j).any() else c[j] for j in range(len(c))]
    dist = d.min(1)
    return [(i, int(o), int(e), int(dist[own == o].sum()), int(dist.sum()), sha(",".join(map(str, c[o])))) for (i, _), o, e in zip(kept, own, dist, strict=True)]


@pytest.mark.parametrize("kind,k,rounds", [("blobs", 40, 6), ("grid", 16, 3), ("copies", 16, 3), ("large", 16, 3)])
def test_clusters_equal_plain_k_means(spark, kind, k, rounds):
    rng = np.random.default_rng(len(kind) + k)
    n, d = 600, 6
    if kind == "blobs":
        x = rng.normal(size=(12, d))[rng.integers(0, 12, n)] * 3 + rng.normal(size=(n, d)) / 4
    elif kind == "grid":  # full of ties
        x = rng.integers(-1, 2, (n, d)) / 64
    elif kind == "copies":
        x = np.concatenate([np.ones((n // 3, d)), rng.normal(size=(n - n // 3, d))])
    else:
        x = rng.normal(size=(n, d)) * 2.0**20
    rows = [(i * 3, [float(v) for v in row]) for i, row in enumerate(x)]
    rows += [(5000, None), (5001, [1.0] * (d - 1)), (5002, [1.0] * (d - 1) + [None]), (5003, [1.0] * (d - 1) + [float("nan")]), (5004, [float("inf")] * d), (0, rows[0][1]), (None, rows[3][1])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    work = []
    got = cluster_vectors(df, k, rounds, dimensions=d, work=work).collect()
    want = slow_clusters(rows, k, rounds, d, 64.0)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert len(work) == rounds + 1
    if kind == "blobs":  # the filters leave well below a full scan after the first round
        assert work[-1] < 0.5 * work[0]


def test_bounds_hold_in_every_round():
    rng = np.random.default_rng(5)
    for trial in range(20):
        x, c = rng.integers(-60, 60, (300, 8)), rng.integers(-60, 60, (int(rng.integers(2, 30)), 8))
        groups, before = group_centroids(c), None
        for r in range(6):
            y = Yinyang(c, groups, before)
            own, upper, lower = y.first(x) if r == 0 else y.next(x, own, upper, lower)
            d = np.sqrt(squared(x, c))
            assert (own == d.argmin(1)).all(), trial
            assert (upper >= d[np.arange(len(x)), own]).all()
            d[np.arange(len(x)), own] = np.inf
            for g in range(y.t):
                assert (lower[:, g] <= d[:, groups == g].min(1)).all()
            before, c = c, c + rng.integers(-4, 5, c.shape) * (rng.random((len(c), 1)) < 0.5)


def test_distances_are_exact_at_any_size():
    rng = np.random.default_rng(1)
    for scale in (10, 2**20, 2**27):
        x, c = rng.integers(-scale, scale, (20, 64)), rng.integers(-scale, scale, (5, 64))
        assert squared(x, c).tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, s, strict=True)) for s in c] for r in x]


def test_clusters_of_few_vectors_and_none(spark):
    df = spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], "vec_id bigint, embedding array<float>")
    got = cluster_vectors(df, 16, 3, dimensions=2).collect()
    assert {(r["vec_id"], r["cluster"], r["distance"]) for r in got} == {(1, 0, 0), (2, 0, 0)}  # a tie goes to the smaller number
    assert cluster_vectors(df.limit(0), dimensions=2).count() == 0 and cluster_vectors(df, dimensions=3).count() == 0
    assert clustering.GROUP > 0


# --- Merkle manifest ---------------------------------------------------------------------------------------------------


def framed(values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def tree(digests, fan):
    """(root, path of each leaf)."""
    paths, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for k, i in enumerate(at):
            run = i - i % fan
            paths[k].append((level[run:i], level[i + 1 : run + fan]))
            at[k] = i // fan
        level = [sha("".join(level[i : i + fan])) for i in range(0, len(level), fan)]
    return level[0], paths


def slow_manifest(rows, fan, change):
    leaves = [(r, sha(framed([r["doc_id"], r["source"], r["text"]])), sha(framed([r["doc_id"], r["source"], change(r)]))) for r in rows]
    subs, of = {}, {}
    for source in {r["source"] for r in rows}:
        own = sorted((x for x in leaves if x[0]["source"] == source), key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1]))
        subs[source], of[source] = (t := tree([x[1] for x in own], fan))[0], (own, t[1])
    order = sorted(subs, key=lambda s: (s is not None, (s or "").encode()))
    root, tops = tree([subs[s] for s in order], fan)
    out = []
    for s, top in zip(order, tops, strict=True):
        for (r, leaf, now), path in zip(*of[s], strict=True):
            acc, sib = now, ""
            for before, after in [*path, *top]:
                acc, sib = sha("".join([*before, acc, *after])), sib + "".join([*before, *after])
            out.append((r["doc_id"], leaf, subs[s], root, sib, acc))
    return out


@pytest.mark.parametrize("fan,small", [(3, True), (3, False), (5, True)])
def test_manifest_equals_a_plain_tree(spark, odd_docs, fan, small, monkeypatch):
    monkeypatch.setattr(merkle, "RUN", 16 if small else 1 << 12)
    monkeypatch.setattr(merkle, "RANGE_ROWS", 20 if small else 1 << 16)
    changed = {"text": F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))}
    got = merkle_manifest(odd_docs, ["doc_id", "source", "text"], "source", "doc_id", changed, fan)
    got = got.select("doc_id", "leaf", "subroot", "root", siblings(F.col("path")).alias("sib"), "folded_root").collect()
    rows = odd_docs.collect()
    want = slow_manifest(rows, fan, lambda r: r["text"] + "!" if r["doc_id"] is not None and r["doc_id"] % 5 == 0 and r["text"] is not None else r["text"])
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    bad = {r["doc_id"] for r in got if r["folded_root"] != r["root"]}
    assert bad == {r["doc_id"] for r in rows if r["doc_id"] is not None and r["doc_id"] % 5 == 0 and r["text"] is not None}


@pytest.mark.parametrize("sources", [["a", "a", "a", "a"], ["a", None, "b"], [None]])
def test_small_trees(spark, sources):
    df = spark.createDataFrame([(i, f"t{i}", "en", s, 1) for i, s in enumerate(sources)], DOCS)
    got = merkle_manifest(df, ["doc_id", "source", "text"], "source", "doc_id").select("doc_id", "leaf", "subroot", "root", siblings(F.col("path")).alias("sib"), "folded_root").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, slow_manifest(df.collect(), 3, lambda r: r["text"])))


def test_manifest_of_nothing(spark, odd_docs):
    got = merkle_manifest(odd_docs.limit(0), ["doc_id"], "source", "doc_id")
    assert got.count() == 0 and dict(got.dtypes)["root"] == "string"
    with pytest.raises(ValueError):
        merkle_manifest(odd_docs, ["doc_id"], "source", "doc_id", fan=1)
