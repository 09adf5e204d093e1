"""What must hold at any size: rare tokens stay rare, indexes are made once, times far apart cost nothing; and twins that share no code."""

import math
import random
import string
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF
from tamis.llm import common as C
from tamis.llm import jaccard_join as J
from tamis.llm import secrets, topk_search, url_filter
from tamis.llm.byte_bpe import ChunkedBpe
from tamis.llm.language_id import fit_language_model
from tamis.llm.queries import QUERIES, tokenizer


# --- Jaccard join ------------------------------------------------------------------------------------------------------


def with_tables(monkeypatch, f):
    """f(), and the tables it wrote, by name."""
    seen, stash = {}, J.stash

    def kept(df, name):
        out = seen[name] = stash(df, name)
        return out

    with monkeypatch.context() as m:
        m.setattr(J, "stash", kept)
        m.setattr(J, "drop", lambda *a: None)
        return f(), seen


@pytest.mark.parametrize("cell", [1, 4096])
def test_a_full_sketch_makes_no_rare_token_hot(spark, monkeypatch, cell):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    run = lambda: sorted(map(tuple, J.jaccard_components(docs).collect()))
    want, plain = with_tables(monkeypatch, run)
    monkeypatch.setattr(J, "SKETCH_BITS", (6, 6))  # a thousand tokens to a counter
    monkeypatch.setattr(J, "CELL", cell)
    got, full = with_tables(monkeypatch, run)
    assert got == want
    assert full["lists"].where("rows < 2 AND list IS NULL").count() == 0 and full["lists"].where("list IS NOT NULL").count() <= 50
    assert full["lists"].count() < 4 * plain["lists"].count()


def test_heaviest_tokens_are_counted_within_their_bound(monkeypatch):
    monkeypatch.setattr(J, "HEAVY", 64)
    rng = np.random.default_rng(3)
    truth, parts, n = Counter(), [], 0
    for _ in range(5):
        h = J.Heaviest()
        for _ in range(40):
            tokens = np.concatenate([rng.zipf(1.3, 300).astype(np.uint64), rng.integers(1 << 40, 1 << 60, 300).astype(np.uint64)])
            truth.update(tokens.tolist())
            n += len(tokens)
            h.add(tokens)
        parts.append(J.Heaviest.unpacked(h.packed()))
    whole = J.Heaviest()
    for h in parts:
        whole.merge(h)
    known = dict(zip(whole.keys.tolist(), whole.counts.tolist(), strict=True))
    assert len(known) <= 64 and all(0 < c <= truth[k] for k, c in known.items())
    assert all(truth[k] - known.get(k, 0) <= n / 64 for k in truth)


def test_what_the_heaviest_bring_leaves_the_counters():
    bits = 6
    heavy, rare = np.uint64(5 << 58 | 7), np.uint64(5 << 58 | 9)  # one counter
    counts = np.full(64, 100)
    counts[5] += 100_000
    rows = pd.DataFrame({"at": [0], "counts": [J.small(counts)]})
    (out,) = J._levels(100.0, J.Heaviest(np.array([heavy]), np.array([100_000])), bits)(iter([rows]))
    levels = np.frombuffer(out["levels"][0], np.uint8)
    assert levels[5] == levels[6] == J.MEAN
    index = J.Postings(levels, J.Heaviest(np.array([heavy]), np.array([100_000])), J.MEAN + 30, J.MEAN + 60, 80)
    assert index.level(np.array([heavy, rare])).tolist() == [int(J.level_of(100_000.0)), J.MEAN]
    assert J.level_of(2.0**33) == 255 and J.most_of(J.level_of(5000.0)) >= 5000


def test_ids_pass_their_filter_and_few_others_do(spark, tmp_path):
    ids = C.stash(spark.range(0, 60_000, 3).select((F.col("id") - 20_000).alias("doc_id")), "ids")
    made, bits = J.id_filter(ids, ids.count())
    on = lambda x: ((np.frombuffer(made, np.uint8)[(b := J._bits_of(np.asarray(x), bits)) >> 3] >> (b & 7).astype(np.uint8)) & 1).reshape(4, -1).all(0)
    assert on(np.arange(-20_000, 40_000, 3)).all() and on(np.arange(10**6, 10**6 + 50_000)).mean() < 0.05


def test_texts_by_filter_are_the_same(spark, monkeypatch):
    rows = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text")).unionByName(spark.createDataFrame([(None, "null")], "doc_id bigint, text string"))
    needed = C.stash(spark.createDataFrame([(i,) for i in range(0, 500, 7)] + [(9999,), (None,)], "doc_id bigint"), "needed")
    few = sorted(map(tuple, J.texts_of(rows, needed).collect()))
    monkeypatch.setattr(C, "BROADCAST_BYTES", -1)
    assert sorted(map(tuple, J.texts_of(rows, needed).collect())) == few == [(i, f"t{i}") for i in range(0, 500, 7)]


# --- URL filter --------------------------------------------------------------------------------------------------------


def test_times_far_apart_make_no_rows(spark, monkeypatch):
    captures = spark.createDataFrame([(1, "http://a1.example/x", "2024-02-01 00:00:00"), (2, "http://a2.example/x", "2024-03-01 00:00:00"), (3, "http://a3.example/x", "9000-01-01 00:00:00"), (4, "http://a4.example/x", "0001-01-01 00:00:00")], "page_id bigint, url string, fetched_at string")
    entries = spark.createDataFrame([(f"a{i}.example", "/", "add", "2024-01-01 00:00:00") for i in range(2000)], "domain string, prefix string, action string, listed_at string")
    counted, stash = {}, url_filter.stash
    monkeypatch.setattr(url_filter, "stash", lambda df, name: (out := stash(df, name), counted.setdefault(name, out.count()))[0])
    got = {r["page_id"]: r["blocked"] for r in url_filter.filter_urls(captures, entries).select("page_id", "blocked").collect()}
    assert got == {1: True, 2: True, 3: True, 4: False} and counted["rules"] == 2000


def test_rules_with_many_intervals_and_many_prefixes(spark):
    rng = random.Random(5)
    day = lambda n: f"{2000 + n // 336:04d}-{n % 336 // 28 + 1:02d}-{n % 28 + 1:02d} 00:00:00"
    entries = [("hot.example", "/", ("add", "remove")[n % 2], day(n * 3)) for n in range(400)]
    entries += [(rng.choice(["hot.example", "www.hot.example"]), "/" + "ab"[k % 2] * (k % 9) + str(k % 5), rng.choice(["add", "remove"]), day(rng.randrange(2000))) for k in range(500)]
    captures = [(i, f"http://{rng.choice(['', 'www.', 'x.www.'])}hot.example/" + rng.choice("ab") * rng.randrange(9) + str(rng.randrange(5)) + "z" * rng.randrange(2), day(rng.randrange(2000))) for i in range(300)]
    got = url_filter.filter_urls(spark.createDataFrame(captures, "page_id bigint, url string, fetched_at string"), spark.createDataFrame(entries, "domain string, prefix string, action string, listed_at string")).collect()
    events = {}
    for domain, prefix, action, at in entries:
        events.setdefault((domain, prefix), {}).setdefault(at, set()).add(action)
    for r, (i, url, at) in zip(sorted(got, key=lambda r: r["page_id"]), captures, strict=True):
        host, _, path = url.removeprefix("http://").partition("/")
        active = []
        for (domain, prefix), own in events.items():
            before = [a for t, a in sorted(own.items()) if t <= at]
            if (host == domain or host.endswith("." + domain)) and ("/" + path).startswith(prefix) and before and before[-1] == {"add"}:
                active.append(domain + prefix)
        assert (r["n_rules"], r["first_rule"], r["blocked"]) == (len(active), min(active, default=None), bool(active))


# --- top-k, byte BPE ---------------------------------------------------------------------------------------------------


def test_an_index_is_made_once_for_all_queries(monkeypatch):
    rng = np.random.default_rng(1)
    block = lambda role, lo, n: {"part": 0, "role": role, "n": n, "d": 8, "ids": np.arange(lo, lo + n).tobytes(), "cells": rng.integers(-50, 50, (n, 8)).tobytes()}
    rows = pd.DataFrame([block(0, 0, 100), *(block(1, 1000 + 10 * k, 10) for k in range(12))])
    made, init = [], topk_search.ImpactIndex.__init__
    monkeypatch.setattr(topk_search.ImpactIndex, "__init__", lambda self, *a: made.append(1) or init(self, *a))
    out = pd.concat(topk_search._meet(3)(iter([rows.iloc[:5], rows.iloc[5:]])))
    assert len(made) == 1 and len(out) == 120 * 3


def test_tasks_do_not_grow_with_queries(spark):
    v = spark.range(3000).select(F.col("id").alias("vec_id"), F.array(*(F.sin(F.col("id") * (k + 1)) for k in range(6))).alias("embedding"))
    hits = topk_search.topk_search(v, v, k=2, block_rows=1000, query_rows=10)
    parts = 3 * math.ceil(topk_search.TILES * spark.sparkContext.defaultParallelism / 3)
    text = hits._jdf.queryExecution().toString()
    assert f"RepartitionByExpression [key" in text and f", {parts}" in text and hits.count() == 6000


@pytest.mark.parametrize("kind", ["letters", "spaces", "mixed"])
def test_cuts_read_a_text_a_few_times_at_most(monkeypatch, kind):
    bpe = ChunkedBpe(*tokenizer(), chunk=512, overlap=64)
    text = {"letters": "a" * 400_000, "spaces": " " * 400_000, "mixed": ("ab cd " * 300 + "x" * 30_000) * 12}[kind]
    read, boundaries = [], ChunkedBpe.boundaries
    monkeypatch.setattr(ChunkedBpe, "boundaries", lambda self, t: read.append(len(t)) or boundaries(self, t))
    cuts = bpe.cuts(text)
    assert sum(read) < 8 * len(text) and cuts[0] == 0 and cuts[-1] == len(text)
    assert set(cuts[1:-1]) <= set(boundaries(bpe, text).tolist())
    if kind == "mixed":
        assert max(b - a for a, b in zip(cuts, cuts[1:], strict=False)) < 2 * 31_800  # a run and what is read around it


# --- twins -------------------------------------------------------------------------------------------------------------


def slow_language(model, text):
    """Family, vote and score from the learned weights, trigram by trigram."""
    if not text or not any(c.isalpha() for c in text):
        return "und", 0.0
    low = [b if b >= 128 or 65 <= b <= 90 or 97 <= b <= 122 else 32 for b in text.lower().encode()]
    low = [32, *low, 32]
    seen = Counter()
    for a, b, c in zip(low, low[1:], low[2:], strict=False):
        if (a, b) != (32, 32):
            seen[((a << 16 | b << 8 | c) * 2654435761 % 2**32) >> 19] += 1
    norm = math.sqrt(sum(seen.values())) or 1.0
    margin = [sum(math.sqrt(n) / norm * float(model.w[k, j]) for k, n in seen.items()) + float(model.bias[j]) for j in range(model.w.shape[1])]
    squash = lambda v: 1 / (1 + math.exp(-4 * v))
    families = sorted({model.family[a] for a in model.langs})
    best, score, skip = families[0], 1.0, 0
    if len(families) > 1:
        skip = len(families)
        ranked = sorted(zip(margin[:skip], families, strict=True), key=lambda x: -x[0])
        best, score = ranked[0][1], squash((ranked[0][0] - ranked[1][0]) / 2)
    members = [a for a in model.langs if model.family[a] == best]
    pairs = [(a, b) for f in families for i, a in enumerate(x for x in model.langs if model.family[x] == f) for b in [x for x in model.langs if model.family[x] == f][i + 1 :]]
    against = {a: [v if a == p else -v for (p, q), v in zip(pairs, margin[skip:], strict=True) if a in (p, q)] for a in members}
    wins = {a: sum(v >= 0 if (a, b) in pairs else v > 0 for v, b in zip(against[a], [x for x in members if x != a], strict=True)) for a in members}
    lang = sorted(members, key=lambda a: (-wins[a], -sum(against[a])))[0]
    if len(members) > 1:
        score *= squash(min(against[lang]))
    share = sum(n for k, n in seen.items() if model.usual[lang][k]) / (sum(seen.values()) or 1)
    return lang, score / (1 + math.exp(-40 * (share - 0.5)))


def test_languages_by_plain_loops(spark):
    got = {r["doc_id"]: r for r in QUERIES["op7_language_id"](spark, SF).collect()}
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    model = fit_language_model(documents)
    for r in documents.collect():
        lang, score = slow_language(model, r["text"])
        assert got[r["doc_id"]]["lang_pred"] == lang and got[r["doc_id"]]["score"] == pytest.approx(score, abs=1e-4)


HEX, LETTERS, DIGITS = set(string.hexdigits), set(string.ascii_letters), set(string.digits)


def split_kinds(run):
    """The run as stretches of letters (a), digits (0) and marks (-)."""
    out = []
    for c in run:
        kind = "a" if c in LETTERS else "0" if c in DIGITS else "-"
        if out and out[-1][0] == kind:
            out[-1][1] += c
        else:
            out.append([kind, c])
    return out


def slow_is_random(run, tokens, most):
    kinds = split_kinds(run)
    shape = "".join(k for k, _ in kinds)
    hexes = all(c in HEX for c in run)
    groups = run.split("-")
    uuid = [len(g) for g in groups] == [8, 4, 4, 4, 12] and all(c in HEX for g in groups for c in g)
    if len(run) < 12 or (hexes and len(run) in (32, 40, 56, 64, 96, 128)) or uuid or "a" not in shape:
        return False
    one = [x for k, x in kinds if k == "0"]
    short = len(one) == 1 and len(one[0]) <= 6
    marks = [x for k, x in kinds if k == "-"]
    name = "0" not in shape or (short and (shape in ("a0", "0a") or (shape == "a-0" and marks[0] in "_-")))
    name = name or (short and shape.endswith("-0") and set(shape[:-1][::2]) == {"a"} and shape[0] == "a" and all(len(m) == 1 and m in "_/-" for m in marks))
    if len(run) < 16:
        return not name and len(run) < 0.85 * most * tokens(run)
    if name:
        words = [x for k, x in kinds if k == "a"]
        return sum(map(len, words)) < 0.95 * most * sum(map(tokens, words))
    return len(run) < most * tokens(run)


def test_random_runs_by_plain_loops(spark):
    enc = secrets.load_tokenizer(*tokenizer())
    tokens = lambda s: len(enc.encode_ordinary(s))
    rng = random.Random(11)
    key = lambda n, alphabet=string.ascii_letters + string.digits: "".join(rng.choice(alphabet) for _ in range(n))
    runs = [key(rng.randrange(8, 40)) for _ in range(300)] + [key(n, string.hexdigits.lower()) for n in (30, 32, 40, 41, 64)] + [key(rng.randrange(12, 30), "0123456789-/") for _ in range(50)]
    runs += ["customer-service-2024", "customerservice12", "123456internationalization", "3f2504e0-4f89-41d3-9a0c-0305e82c3301", "administration/department/office", "a-b_c/1234567", "documentation_v2", key(14) + "-x", key(20, string.ascii_lowercase), "snake_case_name_of_things_99"]
    runs += [f"{rng.choice(['user', 'path', 'zq'])}{rng.choice('-_/')}{key(rng.randrange(4, 9), string.ascii_lowercase)}{rng.choice('-_/+')}{rng.randrange(10**rng.randrange(1, 8))}" for _ in range(300)]
    for run in runs:
        assert secrets.is_random(run, tokens, 2.0) == slow_is_random(run, tokens, 2.0), run
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        # whole runs of the documents: every maximal stretch of key characters, with up to two signs of equality
        want, at, text = [], 0, r["text"] or ""
        inside = lambda c: c in LETTERS or c in DIGITS or c in "+/_-"
        while at < len(text):
            end = at
            while end < len(text) and inside(text[end]):
                end += 1
            if end - at >= 12 and slow_is_random(text[at:end].strip("-_/+"), tokens, 2.0):
                tail = 0
                while tail < 2 and text[end + tail : end + tail + 1] == "=":
                    tail += 1
                want.append((at, 3, end + tail))
            at = max(end, at + 1)
        got = secrets.random_spans(text, lambda s: tokens(s), 2.0)
        assert [s for s in got if slow_is_random(text[s[0] : s[2]].strip("=-_/+"), tokens, 2.0)] == want
