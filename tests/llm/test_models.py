import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamis.llm.language_id import LanguageModel, family_of, fit_language_model, identify_languages, linear_svm
from tamis.llm.mixing import mix_sources, pivotal, source_targets, take_copies
from tamis.llm.quality import FACTORS, FactorisationMachine, WORD_BITS, fit_quality_model, score_quality
from tamis.llm.url_filter import domains_of, filter_urls, host_of, path_of, validity_intervals

SF = "/root/testdata/sf0.01"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


# --- language ----------------------------------------------------------------------------------------------------------


def test_languages_of_held_out_documents(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    got = identify_languages(d).select("doc_id", "lang", "lang_pred", "lang_score").collect()
    own = [r for r in got if held(r["doc_id"])]
    assert len(got) == 1000 and np.mean([r["lang"] == r["lang_pred"] for r in own]) > 0.97
    assert all(0 <= r["lang_score"] <= 1 for r in got)


def test_languages_of_hard_texts(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = fit_language_model(d)
    assert model.predict(None) == model.predict("") == model.predict("123 !?\n") == ("und", 0.0)
    assert model.predict("the of and " * 30000)[0] == "en" and model.predict("der die das und ist nicht")[0] == "de"
    hard = spark.createDataFrame([(1, None, "en"), (1, None, "en"), (2, "", None), (None, "la de que el", "es")], "doc_id bigint, text string, lang string").withColumn("lang_pred", F.lit("clash")).withColumn("score", F.lit(3))
    got = identify_languages(hard, model)
    assert got.columns == ["doc_id", "text", "lang", "score", "lang_pred", "lang_score"] and got.count() == 4
    nothing = identify_languages(hard.drop("lang_pred"))
    assert [r["lang_pred"] for r in nothing.collect()] == ["und"] * 4
    assert identify_languages(hard.limit(0), model).count() == 0


def test_families_then_pairs():
    assert family_of("de") == family_of("en") == "germanic" and family_of("es") == "romance" and family_of("xx") == "xx"
    rng = np.random.default_rng(1)
    words = {"en": "the of and", "de": "der und das", "fr": "les des une", "xx": "qqq zzz jjj"}
    from tamis.llm.language_id import features

    texts = [(lang, " ".join(rng.choice(w.split(), 20))) for lang, w in words.items() for _ in range(20)]
    m = LanguageModel().fit(np.stack([features(t) for _, t in texts]), [a for a, _ in texts])
    assert m.families == ["germanic", "romance", "xx"] and m.pairs == [("de", "en")]
    assert all(m.predict(t)[0] == a for a, t in texts)
    one = LanguageModel().fit(np.stack([features("abc")]), ["en"])
    assert one.predict("anything")[0] == "en"


def test_the_machine_separates_what_is_separable():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 5))
    y = np.where(x[:, 0] + 0.5 > 0, 1.0, -1.0)
    w = linear_svm(x, y, c=100.0, rounds=300)
    assert np.mean(np.sign(x @ w[:-1] + w[-1]) == y) > 0.95


# --- quality -----------------------------------------------------------------------------------------------------------


def test_quality_of_held_out_documents(spark):
    d, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r["score"] for r in score_quality(d, labels).collect()}
    own = [(got[r["doc_id"]] >= 0.5, r["quality"] == 1) for r in labels.collect() if held(r["doc_id"])]
    good = [p for p, q in own if q]
    assert len(got) == 1000 and np.mean([p == q for p, q in own]) > 0.95 and np.mean(good) > 0.97


def test_pairwise_part_in_linear_time():
    n = (1 << WORD_BITS) + 3
    fm = FactorisationMachine(np.zeros(3), np.ones(3))
    rng = np.random.default_rng(3)
    fm.w0, fm.w, fm.v = 0.3, rng.normal(size=n), rng.normal(size=(n, FACTORS))
    x = np.zeros(n)
    at = rng.choice(n, 12, replace=False)
    x[at] = rng.normal(size=12)
    slow = fm.w0 + x @ fm.w + sum(fm.v[i] @ fm.v[j] * x[i] * x[j] for k, i in enumerate(at) for j in at[:k])
    assert fm.margin(x) == pytest.approx(slow)


def test_quality_of_hard_texts(spark):
    hard = spark.createDataFrame([(1, None, None), (2, "", 0), (2, "", 0), (3, "word " * 50000, 250000), (None, "x", -5)], "doc_id bigint, text string, n_chars bigint").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (4, None)], "doc_id bigint, quality int")
    got = score_quality(hard, labels)
    assert got.columns == ["doc_id", "text", "n_chars", "score"] and all(0 <= r["score"] <= 1 for r in got.collect()) and got.count() == 5
    assert {r["score"] for r in score_quality(hard, labels.limit(0)).collect()} == {0.5}
    assert fit_quality_model(hard, labels.where("quality = 1")) is None
    assert score_quality(hard.drop("n_chars"), labels).count() == 5 and score_quality(hard.limit(0), labels).count() == 0


# --- mixing ------------------------------------------------------------------------------------------------------------


def model_targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    target, free, left = {}, [s for s in order], float(sum(sizes.values()))
    while free:
        share = left / sum(w[s] for s in free)
        over = [s for s in free if share * w[s] > most * sizes[s] or sizes[s] == 0]
        if not over:
            return target | {s: share * w[s] for s in free}
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
            free.remove(s)
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1000, "b": 1, "c": 2, None: 30}, {"a": 0, "b": 5}, {"a": 0}, {"é": 7, "z": 70, "Z": 700, "": 3, None: 1}])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size bigint")
    got = {r["_key"]: r["target"] for r in source_targets(df).collect()}
    assert got == pytest.approx({"n" if s is None else "s" + s: t for s, t in model_targets(sizes).items()})


def test_pivotal_rounding_keeps_words_and_means():
    rng = np.random.default_rng(4)
    size, p = rng.integers(1, 50, 12), rng.uniform(0.1, 0.9, 12)
    mean = np.zeros(12)
    for _ in range(4000):
        out = pivotal(p, size, rng.random(12))
        assert out @ size == pytest.approx(p @ size) and np.sum((out > 0) & (out < 1)) <= 1
        mean += out / 4000
    assert np.abs(mean - p).max() < 0.04
    assert pivotal(np.array([0.5, 1.0, 0.0]), np.array([0, 5, 5]), np.array([0.4, 0.5, 0.5])).tolist() == [1.0, 1.0, 0.0]


def mixture(spark, n=900):
    rng = random.Random(5)
    rows = [(i, " ".join("w" for _ in range(rng.choice([0, 1, 5, 20, 60]))), "hot" if i % 3 else rng.choice(["a", "b", None])) for i in range(n)]
    rows += [(n, None, "a"), (7, "w w w", "a"), (7, "w w w", "a"), (None, "w w", "b")]
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, source string")


@pytest.mark.parametrize("bucket", [1024, 16])
def test_mix_meets_its_targets_and_repeats(spark, bucket, monkeypatch):
    import tamis.llm.mixing as X

    monkeypatch.setattr(X, "BUCKET_ROWS", bucket)
    monkeypatch.setattr(X, "FAN", 4)
    rows, df = mixture(spark)
    got = mix_sources(df.withColumn("size", F.lit("clash")).repartition(3))
    out = got.collect()
    assert len(out) == len(rows) and all(r["size"] == len((r["text"] or "").split()) and r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3 for r in out)
    for s in {r[2] for r in rows}:
        own = [r for r in out if r["source"] == s]
        assert {r["source_size"] for r in own} == {sum(r["size"] for r in own)}
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) < 60
    key = lambda rs: sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"], r["taken"]) for r in rs)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    assert key(out) == key(mix_sources(df.repartition(5)).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    taken = take_copies(got, ["doc_id"])
    assert taken.count() == sum(r["copies"] for r in out)


def test_mix_numbers_many_repeated_rows(spark, monkeypatch):
    import tamis.llm.mixing as X

    monkeypatch.setattr(X, "BUCKET_ROWS", 16)
    rows = [(None, f"w {i}", "a") for i in range(100)] + [(None, "w w", "b")] * 300 + [(i, "w " * (i % 7), "c") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    key = lambda rs: sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"], r["target"], r["taken"]) for r in rs)
    slim, whole = mix_sources(df.repartition(5), keep=["doc_id"]).collect(), mix_sources(df.repartition(3)).collect()
    assert len(slim) == len(rows) and key(slim) == key(whole)
    for s in "abc":
        own = [r for r in whole if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 7
    keys = X.repeated_keys(df, ["text", "source"])
    numbered = X.number_repeats(df.select("text", "source"), ["text", "source"], "no", keys).collect()
    assert sorted(r["no"] for r in numbered if r["source"] == "b") == list(range(300)) and {r["no"] for r in numbered if r["source"] == "a"} == {0}


def test_mix_of_nothing(spark):
    _, df = mixture(spark, 3)
    assert mix_sources(df.limit(0)).count() == 0
    blank = mix_sources(df.withColumn("text", F.lit(" "))).collect()
    assert all(r["taken"] == 0 and r["target"] == 0.0 for r in blank)


# --- URLs --------------------------------------------------------------------------------------------------------------


def test_parts_of_urls(spark):
    urls = ["http://User@M.Example.com.:80/de/x?y#z", "//cdn.example.org", "no url", "", None, "https://example.net?q=/de/", "http:///path"]
    df = spark.createDataFrame([(u,) for u in urls], "u string").coalesce(1)
    assert [r[0] for r in df.select(host_of(F.col("u"))).collect()] == ["m.example.com", "cdn.example.org", None, None, None, "example.net", None]
    assert [r[0] for r in df.select(path_of(F.col("u"))).collect()][:2] == ["/de/x", "/"]
    assert df.select(domains_of(host_of(F.col("u")))).first()[0] == ["m.example.com", "example.com", "com"]
    addresses = spark.createDataFrame([("http://[2001:DB8::1]:80/x",), ("http://me@[::1]",), ("http://10.0.0.1:8080/",)], "u string").coalesce(1)
    assert [(r[0], r[1]) for r in addresses.select(host_of(F.col("u")), domains_of(host_of(F.col("u")))).collect()] == [(h, [h]) for h in ("[2001:db8::1]", "[::1]", "10.0.0.1")]


ENTRIES = "domain string, prefix string, action string, listed_at string"


def test_intervals_and_the_as_of_join(spark, monkeypatch):
    import tamis.llm.common as C

    entries = spark.createDataFrame([
        ("Example.com", None, "add", "2024-01-10 00:00:00"), ("example.com", "/", "remove", "2024-03-01 00:00:00"), ("example.com", "/", "add", "2026-01-01 00:00:00"),
        ("m.example.com", "/de/", "add", "2024-02-01 00:00:00"), ("both.net", "/", "add", "2024-01-01 00:00:00"), ("both.net", "/", "remove", "2024-01-01 00:00:00"),
        (None, "/", "add", "2024-01-01 00:00:00"), ("x.org", "/", "what", "2024-01-01 00:00:00"), ("x.org", "/", "add", None),
    ], ENTRIES)
    assert validity_intervals(entries).count() == 3
    rows = [
        (1, "http://m.example.com/de/a", "2024-01-09 23:59:59", 0), (2, "http://m.example.com/de/a", "2024-01-10 00:00:00", 1), (3, "http://m.example.com/de/a", "2024-02-15 00:00:00", 2),
        (4, "http://m.example.com/en/a", "2024-02-15 00:00:00", 1), (5, "http://m.example.com/de/a", "2024-03-01 00:00:00", 1), (6, "http://example.com", "2027-05-05 00:00:00", 1),
        (7, "http://notexample.com/", "2024-02-15 00:00:00", 0), (8, None, "2024-02-15 00:00:00", 0), (9, "http://example.com", None, 0), (10, "http://both.net/", "2024-06-01 00:00:00", 0), (4, "http://m.example.com/en/a", "2024-02-15 00:00:00", 1),
    ]
    captures = spark.createDataFrame([r[:3] for r in rows], "page_id bigint, url string, fetched_at string").withColumn("host", F.lit("clash")).withColumn("rule", F.lit("clash")).repartition(3)
    for most in (None, -1):
        if most:
            monkeypatch.setattr(C, "BROADCAST_BYTES", most)
        got = filter_urls(captures, entries).collect()
        assert sorted((r["page_id"], r["n_rules"]) for r in got) == sorted((r[0], r[3]) for r in rows)
        assert all(r["blocked"] == (r["n_rules"] > 0) for r in got)
        assert next(r["first_rule"] for r in got if r["page_id"] == 3) == "example.com/"
    assert not any(r["blocked"] for r in filter_urls(captures, entries.limit(0)).collect())
    assert filter_urls(captures.limit(0), entries).count() == 0
