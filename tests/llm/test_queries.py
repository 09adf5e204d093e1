"""The registered queries as the driver runs them: against their SQL, or against slow twins over the whole table."""

import hashlib
import os
import random
import re
import string
import time
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF
from tamis.llm import quality, secrets
from tamis.llm.language_id import fit_language_model
from tamis.llm.queries import ORACLES, QUERIES, tokenizer, visible_lines


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in os.listdir(SF):
        c.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{t}')")
    return c


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = con.execute(ORACLES[name]).df()[cols].values.tolist()
    assert sorted(map(repr, (tuple(r) for r in df.select(*cols).collect()))) == sorted(repr(tuple(None if v is pd.NA or v is None else v for v in r)) for r in want)


ODD_HTML = ["<p>", "</p>", "<P class='a'>", "<pé>", "<pre>", "<p_>", "<br/>", "<br", "<h1>", "<h7>", "<script>", "</SCRIPT \n>", "</script\x0b>", "<ſcript>", "</ſcript>", "<ſection>", "<style>", "</style>", "<head>", "</head>", "<header>", "<!--", "-->", "<", ">", "<di", "v>", "<b>", " ", "  ", "\t", "\r", "\n", "\r\n", "\f", "\x0b", "\x85", "\xa0", "\u2028", "a", "bc d", "é", "😀", "x\n"]


def test_lines_of_odd_pages_are_those_of_the_sql(spark, tmp_path):
    rng = random.Random(5)
    pages = [(k, f"https://{k % 40}.example.org/", "".join(rng.choice(ODD_HTML) for _ in range(rng.randint(0, 25)))) for k in range(2000)]
    pages += [(2000, None, None), (2001, "x", ""), (2002, None, "\n\x0b"), (2003, "x", "a\n\u2028")]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    df = QUERIES["op4_line_dedup"](spark, str(tmp_path))
    want = c.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLES['op4_line_dedup']})").fetchall()
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)


def test_time_of_a_page_is_in_proportion_to_its_blanks(spark):
    pages = spark.range(1).select(F.concat(F.lit("a"), F.repeat(F.lit(" "), F.lit(200_000)), F.lit("b<p> c")).alias("html"))
    began = time.monotonic()
    assert pages.select(F.length(visible_lines(F.col("html")))).first()[0] == 200_004
    assert time.monotonic() - began < 5


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def slow_spans(text):
    """The base kinds, read off the contract."""
    out = []
    for kind, pattern, group, least, flags in (("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, re.I | re.A), ("access", r"AKIA[A-Z0-9]+", 0, 20, 0), ("hex", r"[0-9a-f]+", 0, 24, 0)):
        out += [(m.start(), ("assign", "access", "hex").index(kind), m.end(), kind) for m in re.finditer(pattern, text, flags) if len(m[group]) >= least]
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out)]


def test_secrets_of_the_whole_table(spark, docs):
    got = {r["doc_id"]: r for r in QUERIES["op3_secret_scan"](spark, SF).collect()}
    assert len(got) == len(docs)
    for doc_id, text in zip(docs["doc_id"], docs["text"], strict=True):
        base, r = slow_spans(text or ""), got[doc_id]
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [s for s in r["spans"].split(",") if s and not s.startswith("random")] == base
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s.startswith(k) for s in base) for k in ("assign", "access", "hex")]


def test_planted_random_strings_are_found_and_words_are_not(docs):
    enc = secrets.load_tokenizer(*tokenizer())
    count = lambda run: len(enc.encode_ordinary(run))
    rng = random.Random(3)
    texts = [t for t in docs["text"] if t][:100]

    def recall(alphabet, n, before="", times=300):
        found = 0
        for _ in range(times):
            text, key = rng.choice(texts)[:300], "".join(rng.choice(alphabet) for _ in range(n))
            at = len(text) + 1 + len(before)
            spans = secrets.random_spans(f"{text} {before}{key} {text}", count, 2.0)
            found += any(a < at + n and at < b for a, _, b in spans)
        return found / times

    base62 = string.ascii_letters + string.digits
    assert min(recall(base62, n) for n in (16, 24, 40)) >= 0.98 and min(recall(string.ascii_letters, n) for n in (16, 24)) >= 0.98
    assert recall(base62, 14) >= 0.8 and recall(string.ascii_lowercase + string.digits, 15) >= 0.85 and recall(string.ascii_lowercase, 24) >= 0.88
    assert recall(base62, 24, "config/production/settings/") >= 0.95
    spans = sum(len(secrets.random_spans(t, count, 2.0)) for t in docs["text"] if t)
    assert spans <= 2


def test_quality_scores_equal_the_sum_over_all_pairs(spark, docs):
    got = {r["doc_id"]: r for r in QUERIES["op6_quality"](spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit_quality_model(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    for (words, stats), doc_id in zip(quality.rows(docs["text"].tolist(), docs["n_chars"].astype(float).tolist()), docs["doc_id"], strict=True):
        x = model.inputs(words, stats)
        on = np.flatnonzero(x)
        pairs = np.triu((model.v[on] @ model.v[on].T) * np.outer(x[on], x[on]), 1).sum()
        want = 1 / (1 + np.exp(-np.clip(model.w0 + x @ model.w + pairs, -30, 30)))
        r = got[doc_id]
        assert r["score"] == pytest.approx(want, abs=1e-8) and r["held_out"] == held_out(doc_id) and r["predicted"] == int(r["score"] >= 0.5)
    known = {r["doc_id"]: r["quality"] for r in labels.collect() if r["quality"] is not None and held_out(r["doc_id"])}
    assert np.mean([got[d]["predicted"] == q for d, q in known.items()]) >= 0.9


def test_languages_equal_the_model_text_by_text(spark, docs):
    got = {r["doc_id"]: r for r in QUERIES["op7_language_id"](spark, SF).collect()}
    model = fit_language_model(spark.read.parquet(f"{SF}/documents.parquet"))
    right = []
    for doc_id, text, lang in zip(docs["doc_id"], docs["text"], docs["lang"], strict=True):
        r = got[doc_id]
        assert (r["lang_pred"], r["score"]) == pytest.approx(model.predict(text)) and r["held_out"] == held_out(doc_id)
        if held_out(doc_id) and lang is not None:
            right.append(r["lang_pred"] == lang)
    assert np.mean(right) >= 0.9
    assert [model.predict(t) for t in ("½ ² ③", "Ⅷ 123", "", None, " \n")] == [("und", 0.0)] * 5


def test_tokens_equal_the_library(spark, docs):
    enc = secrets.load_tokenizer(*tokenizer())
    got = {r["doc_id"]: r for r in QUERIES["op8_byte_bpe"](spark, SF).collect()}
    for doc_id, text in zip(docs["doc_id"], docs["text"], strict=True):
        ids = enc.encode_ordinary(text or "")
        r = got[doc_id]
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_mixing_meets_the_targets_of_a_plain_model(spark, docs):
    got = QUERIES["op9_source_mixing"](spark, SF).toPandas().merge(docs[["doc_id", "text", "source"]], on="doc_id")
    assert len(got) == len(docs) and got["size"].tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in got["text"]]
    sizes = got.groupby(got["source"].fillna("\U0010ffff"))["size"].sum().sort_index()
    weight, total = [(1, 2, 3)[k % 3] for k in range(len(sizes))], sizes.sum()
    capped: set[int] = set()
    while True:
        free = total - sum(3 * s for k, s in enumerate(sizes) if k in capped)
        level = free / sum(w for k, w in enumerate(weight) if k not in capped)
        more = {k for k, s in enumerate(sizes) if k not in capped and level * weight[k] > 3 * s}
        if not more:
            break
        capped |= more
    for k, source in enumerate(sizes.index):
        own = got[got["source"].fillna("\U0010ffff") == source]
        target = 3 * sizes.iloc[k] if k in capped else level * weight[k]
        assert own["target"].tolist() == pytest.approx([target] * len(own))
        assert abs(own["taken"].sum() - target) <= own["size"].max() and (own["taken"] <= 3 * own["size"]).all()
