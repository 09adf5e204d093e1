"""Callers' columns may bear any name, those that operators use within included."""

import os
import re

import pytest
from pyspark.sql import functions as F

import tamis.llm
from tamis.llm.byte_bpe import encode_documents
from tamis.llm.clustering import cluster_vectors
from tamis.llm.embedding_dedup import embedding_near_duplicates
from tamis.llm.jaccard_join import jaccard_components, one_of_each
from tamis.llm.language_id import identify_languages
from tamis.llm.line_dedup import drop_boilerplate
from tamis.llm.merkle import merkle_manifest
from tamis.llm.mixing import mix_sources, take_copies
from tamis.llm.quality import score_quality
from tamis.llm.queries import tokenizer
from tamis.llm.secrets import scan_secrets
from tamis.llm.sharding import shard_records
from tamis.llm.topk_search import topk_search
from tamis.llm.url_filter import filter_urls

HERE = os.path.dirname(tamis.llm.__file__)
#: Every name in quotes that looks like a column's, out of the operators' sources.
NAMES = sorted({n.lower() for f in os.listdir(HERE) if f.endswith(".py") for n in re.findall(r'"(_?[a-z][a-z0-9_]{0,15})"', open(os.path.join(HERE, f)).read())})
OWN = {"doc_id", "text", "lang", "source", "n_chars", "vec_id", "embedding", "label", "page_id", "url", "fetched_at"}
#: Columns that operators say they replace.
NEW = {"n_lines", "n_dropped", "lang_pred", "lang_score", "size", "source_size", "target", "copies", "taken", "score"}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, " ".join(f"w{(i * 7 + k) % 50}" for k in range(12)) + "\nline\n" + "x" * (i % 5), ["en", "de"][i % 2], f"s{i % 3}", 5) for i in range(60)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def wide(df):
    """df with a column of each name, which holds it."""
    return df.select("*", *(F.lit(f"={n}").alias(n) for n in NAMES if n not in {c.lower() for c in df.columns}))


PASSING = {
    "lines": lambda d: drop_boilerplate(d),
    "lines, copies once": lambda d: drop_boilerplate(d, copies_once=True),
    "languages": lambda d: identify_languages(d),
    "quality": lambda d: score_quality(d),
    "mix": lambda d: mix_sources(d),
    "mixed rows": lambda d: take_copies(mix_sources(d), [c for c in d.columns if c.lower() not in NEW]),
    "one of each": lambda d: one_of_each(d),
}


@pytest.mark.parametrize("broadcast", [32 << 20, -1])
@pytest.mark.parametrize("name", PASSING)
def test_columns_pass_through(spark, docs, name, broadcast, monkeypatch):
    import tamis.llm.common as C

    monkeypatch.setattr(C, "BROADCAST_BYTES", broadcast)
    plain, got = PASSING[name](docs), PASSING[name](wide(docs))
    assert {c.lower() for c in got.columns} >= set(NAMES) - NEW
    rows = got.collect()
    assert len(rows) == plain.count() > 0
    assert all(r[n] == f"={n}" for r in rows for n in NAMES if n not in NEW | OWN)


ASIDE = {
    "secrets": lambda d: scan_secrets(d, *tokenizer()),
    "tokens": lambda d: encode_documents(d, *tokenizer(), digests=True),
    "components": lambda d: jaccard_components(d),
    "shards": lambda d: shard_records(d, [1.0, 2.0]),
    "manifest": lambda d: merkle_manifest(d, ["doc_id", "source", "text"], "source", "doc_id", {"text": F.upper("text")}),
}


@pytest.mark.parametrize("name", ASIDE)
def test_other_columns_are_ignored(spark, docs, name):
    assert sorted(map(str, ASIDE[name](wide(docs)).collect())) == sorted(map(str, ASIDE[name](docs).collect()))


def test_vectors_and_urls_ignore_other_columns(spark):
    v = spark.createDataFrame([(i, [1.0, i / 9, 0.5], i % 2) for i in range(40)], "vec_id bigint, embedding array<float>, label int")
    for f in (embedding_near_duplicates, lambda d: topk_search(d, d.where("vec_id % 5 = 0")), lambda d: cluster_vectors(d, 4, 2, dimensions=3)):
        assert sorted(map(str, f(wide(v)).collect())) == sorted(map(str, f(v).collect()))
    u = spark.createDataFrame([(i, f"http://h{i % 3}.example.org/de/", "2024-05-01 00:00:00") for i in range(9)], "page_id bigint, url string, fetched_at string")
    entries = spark.createDataFrame([("h1.example.org", "/", "add", "2000-01-01 00:00:00")], "domain string, prefix string, action string, listed_at string")
    got = filter_urls(wide(u), entries).collect()
    assert sorted(map(str, got)) == sorted(map(str, filter_urls(u, entries).collect())) and sum(r["blocked"] for r in got) == 3
