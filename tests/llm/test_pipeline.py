"""The pipeline stage by stage against brute force on whole small tables."""

import hashlib
import random
import string
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tamis.llm.language_id import fit_language_model
from tamis.llm.line_dedup import LEAST_PAGES, RATIO
from tamis.llm.queries import tokenizer
from tamis.llm.secrets import load_tokenizer
from test_models import model_targets
from test_texts import brute_components

SF = "/root/testdata/sf0.001"
HARD = [(9001, None, "en", "src1", None), (9002, "", None, None, 0), (9003, "123 !", "en", "", 5), (9003, "123 !", "en", "", 5), (9004, "the words " * 30000, "en", "src1", 1), (0, "a row of the same id that reads otherwise than the first", "en", "src2", 9)]


def stage_rows(df):
    return Counter(tuple(r) for r in df.select(*P.COLUMNS).collect())


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*P.COLUMNS)
    docs = docs.unionByName(spark.createDataFrame(HARD, docs.schema)).unionByName(docs.where("doc_id IN (5, 6)"))
    out, at = [P.stash(docs, "start")], None
    for name, f in P.STAGES:
        at = P.stash(f(spark, out[-1].withColumn("extra", F.lit(1)) if at is None else out[-1], SF), name)
        out.append(at)
    return out


def test_names_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "jaccard_join", "source_mixing", "byte_bpe"]
    assert all(d.columns == P.COLUMNS for d in stages[1:-1]) and stages[-1].columns[0] == "doc_id"


def test_language_stage(stages):
    model = fit_language_model(stages[0])
    want = Counter({r: n for r, n in stage_rows(stages[0]).items() if model.predict(r[1])[0] != "und" and model.predict(r[1])[1] >= P.LEAST_LANGUAGE_SCORE})
    got = stage_rows(stages[1])
    assert got == want and sum(got.values()) >= 200 and not any(r[0] in (9001, 9002, 9003) for r in got)


def test_line_stage(stages):
    rows = stage_rows(stages[1])
    pages, seen = Counter(), Counter()
    for r, n in rows.items():
        pages[r[3]] += n
        for line in set((r[1] or "").split("\n")) - {""}:
            seen[r[3], line] += n
    gone = {k for k, n in seen.items() if n >= LEAST_PAGES and n > RATIO * pages[k[0]]}
    want = Counter()
    for r, n in rows.items():
        kept = [x for x in r[1].split("\n") if (r[3], x) not in gone]
        text = "\n".join(kept)
        if text == r[1]:
            want[r] += n
        elif text.strip():
            want[(r[0], text, r[2], r[3], len(text))] += n
    assert gone and stage_rows(stages[2]) == want


def test_near_copy_stage(stages):
    rows = sorted(stage_rows(stages[2]), key=lambda r: (r[0], r[1]))
    comp = brute_components([r[1] for r in rows])
    first = {}
    for k, r in enumerate(rows):
        first[comp[k][1]] = min(r[0], first.get(comp[k][1], r[0]))
    gone = {r[0] for k, r in enumerate(rows) if first[comp[k][1]] != r[0]}
    assert gone and stage_rows(stages[3]) == Counter(r for r in rows if r[0] not in gone)


def test_mixing_stage(stages):
    kept, got = stage_rows(stages[3]), stage_rows(stages[4])
    assert set(got) <= set(kept) and all(n <= 3 * kept[r] for r, n in got.items())
    size = lambda r: len(r[1].split())
    by = {}
    for r, n in kept.items():
        by[r[3]] = by.get(r[3], 0) + n * size(r)
    for s, t in model_targets(by).items():
        own = [r for r in kept if r[3] == s]
        assert abs(sum(n * size(r) for r, n in got.items() if r[3] == s) - t) <= max(map(size, own))


def test_token_stage(stages):
    enc, want = load_tokenizer(*tokenizer()), Counter()
    for r, n in stage_rows(stages[4]).items():
        ids = np.array(enc.encode_ordinary(r[1]), "<u4")
        want[r[0], len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(r[1].encode()).hexdigest()] += n
    assert Counter(tuple(r) for r in stages[5].collect()) == want


def test_run_gives_the_rows_of_the_last_stage(spark):
    n = P.run(spark, SF).count()
    assert n > 100


def test_language_stage_rejects_what_was_not_learned(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*P.COLUMNS)
    rng = random.Random(7)
    letters = lambda n, of: " ".join("".join(rng.choice(of) for _ in range(rng.randint(3, 9))) for _ in range(n))
    alien = [
        "Все люди рождаются свободными и равными в своем достоинстве и правах.",
        "人人生而自由,在尊严和权利上一律平等。",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
        *(letters(n, string.ascii_lowercase) for n in (10, 50, 300)),
        *(letters(n, string.ascii_letters) for n in (10, 50, 300)),
    ]
    rows = spark.createDataFrame([(8000 + i, t, None, "src1", len(t)) for i, t in enumerate(alien)], docs.schema)
    got = {r["doc_id"] for r in P.language_id(spark, docs.unionByName(rows), SF).collect()}
    assert got == {r["doc_id"] for r in docs.collect()}


def test_a_large_group_of_copies_leaves_one_document(spark):
    own = [(i, f"line {i} of its own\nthe boiler line\n" + " ".join(f"w{i}x{k}" for k in range(30)), "en", "a", 0) for i in range(20)]
    copies = [(100 + i, "a clean text that many rows copy\nand its second line of words", "en", "a", 0) for i in range(10)]
    few = [(200 + i, "three copies in a small source\nthat has no other lines", "en", "b", 0) for i in range(3)]
    docs = spark.createDataFrame([*own, *copies, *few], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = {r["doc_id"]: r["text"] for r in P.jaccard_join(spark, P.stash(P.line_dedup(spark, docs, SF), "lines"), SF).collect()}
    assert sorted(kept) == [*range(20), 100, 200]
    assert kept[100] == copies[0][1] and kept[200] == few[0][1]
    assert not any("boiler" in kept[i] for i in range(20))
