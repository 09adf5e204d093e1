import io
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamis.operators import retrieval as V
from tamis.operators.detection import ScriptedDetector, ServiceDetector, detect, lexicon_answer
from tamis.plans import screening as S
from tamis.schemas import SEED, Screening, Taxonomy, literals
from tamis.sources import files as I

RED = ["small_business_set_aside", "lpta_source_selection"]


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)


@pytest.mark.parametrize("flags,threshold,want", [([], 1, False), (["x"], 1, False), (["agile_methodology"], 1, False), (["8a_set_aside"], 1, False), (RED[:1], 3, False), (RED, 2, True), (RED, 1, True), (RED, 999, False)])
def test_decision(spark, flags, threshold, want):
    assert spark.range(1).select(S.filters_out(literals(flags), Taxonomy(), threshold)).first()[0] is want


def test_a_black_flag_always_filters(spark):
    assert spark.range(1).select(S.filters_out(literals(["b"]), Taxonomy({"b": "black", "r": "red"}), 999)).first()[0]


def screened(spark, answers, text="one two three", **settings):
    return S.screen(docs(spark, text), lambda: ScriptedDetector(answers), Screening(**settings)).first()


def test_screening_with_scripted_answers(spark):
    r = screened(spark, ["garbage", RED[0]])
    assert (r["flags"], r["unparsed_chunks"], r["total_chunks"], r["filter_out"]) == ([RED[0]], 0, 1, False)
    r = screened(spark, ["garbage", "rubbish"])
    assert (r["flags"], r["unparsed_chunks"]) == ([], 1)
    r = screened(spark, [RuntimeError("down")])
    assert (r["flags"], r["unparsed_chunks"], r["filter_out"]) == ([], 1, False)
    r = screened(spark, [RuntimeError("never called")], text="  ")
    assert (r["flags"], r["unparsed_chunks"], r["total_chunks"], r["filter_out"]) == ([], 0, 0, False)
    three = " ".join(f"w{i}" for i in range(25))
    r = screened(spark, [RED[0], "no_flag", RED[1]], text=three, max_tokens=13, overlap_tokens=0, red_threshold=2)
    assert (r["flags"], r["total_chunks"], r["filter_out"]) == (sorted(RED), 3, True)
    r = screened(spark, [RED[0]], text=three, max_tokens=13, overlap_tokens=0)
    assert (r["flags"], r["filter_out"]) == ([RED[0]], False)


def test_attempts_and_errors_are_data(spark):
    chunks = spark.createDataFrame([("a",)], "prompt string")
    one = lambda answers: detect(chunks, lambda: ScriptedDetector(answers), Taxonomy()).first()
    assert (one(["x", "none"])["attempts"], one(["x", "none"])["parsed"]) == (2, True)
    assert one(["no_flag"])["attempts"] == 1
    r = one([ValueError("oops")])
    assert (r["attempts"], r["parsed"], r["error"]) == (1, False, "ValueError: oops")


def test_the_native_path_agrees_with_the_udf_path(spark):
    terms = {RED[0]: "alpha", RED[1]: "beta"}

    class Lexicon:
        def detect(self, chunk):
            return "\n".join(f for f, t in terms.items() if t in chunk.lower()) or "no_flag"

    df = docs(spark, "Alpha beta", "gamma", "", None, "alpha " * 50)
    settings = Screening(max_tokens=13, overlap_tokens=3, red_threshold=2)
    a = S.screen_answers(df, lambda c: lexicon_answer(c, terms), settings).orderBy("doc_id").collect()
    assert a == S.screen(df, Lexicon, settings).select(a[0].__fields__).orderBy("doc_id").collect()
    assert [r["filter_out"] for r in a] == [True, False, False, False, False] and a[4]["total_chunks"] > 1


def test_service_detector_waits_for_rate_limits_only():
    calls = []

    def invoke(body):
        calls.append(body)
        if len(calls) < 3:
            raise TimeoutError
        return '{"generation": "no_flag"}'

    d = ServiceDetector(invoke, is_throttled=lambda e: isinstance(e, TimeoutError), waits=(0, 0, 0))
    assert d.detect("x") == "no_flag" and len(calls) == 3 and '"max_gen_len": 64' in calls[0]
    with pytest.raises(KeyError):
        ServiceDetector(lambda b: {}["x"], waits=(0,)).detect("x")


def test_context_goes_into_prompts(spark):
    seen = S.screen(docs(spark, "the chunk"), lambda: type("D", (), {"detect": lambda self, p: RED[0] if "Example 1:\npassage" in p else "no_flag"})(), Screening(), retrieve=lambda c: c.withColumn("passages", literals(["passage"])))
    assert seen.first()["flags"] == [RED[0]]


def test_tiers_and_reports(spark):
    got = S.screen_answers(docs(spark, "alpha"), lambda c: lexicon_answer(c, {RED[0]: "alpha", "agile_methodology": "a"}), Screening(red_threshold=1))
    t = S.screen_by_tier(got, Taxonomy()).first()
    assert (t["red"], t["green"], t["blue"], t["black"]) == ([RED[0]], ["agile_methodology"], [], [])
    assert S.report(got).first()["report"].startswith("FILTER: agile_methodology, small")
    old = spark.createDataFrame([(0, [], ["z"], [], [])], "doc_id bigint, black array<string>, red array<string>, green array<string>, blue array<string>")
    m = S.merge_tiers(old, S.screen_by_tier(got, Taxonomy())).first()
    assert m["red"] == [RED[0], "z"] and not m["failed"]


def test_store(spark, tmp_path):
    store = V.PassageStore(spark, f"file://{tmp_path}/store")
    passages = spark.createDataFrame([(0, "a", "red apples and pears"), (1, "b", "the moon at night"), (2, "a", "apples in a basket"), (3, "c", "software in sprints")], "pos bigint, flag string, passage string")
    empty = store.query(spark.createDataFrame([(1, "apples")], "query_id bigint, text string"))
    assert store.count() == 0 and empty.count() == 0
    assert (store.add(passages), store.add(passages), store.count()) == (4, 0, 4)
    hits = store.query(spark.createDataFrame([(1, "apples in a basket")], "query_id bigint, text string"), 2).first()["hits"]
    assert len(hits) == 2 and hits[0]["passage"] == "apples in a basket" and hits[0]["distance"] < 1e-9
    assert store.fill_once(lambda: passages) == 0
    fresh = V.PassageStore(spark, f"file://{tmp_path}/fresh")
    assert fresh.fill_once(lambda: None) == 0 and fresh.fill_once(lambda: passages) == 4
    assert {r["id"] for r in V.passage_ids(passages, prefix="real_").collect()} == {"real_a_0", "real_a_1", "real_b_0", "real_c_0"}


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 16)).astype(np.float32)
    x[7] = x[8] = x[9]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, embedding array<float>")
    ask = df.where("id % 30 = 9").select(F.col("id").alias("query_id"), "embedding")
    got = [(r["query_id"], r["rank"], r["id"]) for r in V.top_k(ask, df, 4, block_rows=100).orderBy("query_id", "rank").collect()]
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    want = []
    for q in range(9, 300, 30):
        d = np.round(1 - u @ u[q], 12)
        want += [(q, k + 1, int(i)) for k, i in enumerate(np.lexsort((np.arange(300), d))[:4])]
    assert got == want
    assert V.top_k(ask, df.where("id < 2"), 4).groupBy("query_id").count().agg(F.max("count")).first()[0] == 2


def docx(*paragraphs):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    body = "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:body>{body}</w:body></w:document>")
    return out.getvalue()


def test_files_of_folders(spark, tmp_path):
    for folder, name, content in (("r1", "b.docx", docx("two", " ", "three")), ("r1", "a.DOCX", docx("one")), ("r1", "n.txt", b"x"), ("r2", "bad.docx", b"no zip"), (".hid", "c.docx", docx("x")), ("skip", "d.docx", docx("x"))):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_bytes(content)
    got = I.extract_files(spark, f"file://{tmp_path}")
    by = {r["name"]: r for r in got.collect()}
    assert by["b.docx"]["text"] == "two\n\nthree" and by["n.txt"]["error"] == "Unsupported file type: .txt" and "BadZipFile" in by["bad.docx"]["error"]
    texts = I.folder_texts(I.discover(got, skip=["skip"])).collect()
    assert [(r["rfp_id"], r["text"]) for r in texts] == [("r1", "one\n\ntwo\n\nthree")]
    assert {r["folder"] for r in I.discover(got, excludes=["r2"]).collect()} == {"r1", "skip"}


def test_packages(spark):
    df = spark.createDataFrame([("p", 1, "b.pdf", "B"), ("p", 0, "a.pdf", "A"), ("q", 0, "c.pdf", "C")], "package string, pos int, name string, text string")
    got = {r["package"]: r["text"] for r in I.combine_packages(df, "package", "pos", "name", "text").collect()}
    rule = "=" * 40
    assert got == {"q": "C", "p": f"MULTI-DOCUMENT PACKAGE (2 documents)\n\n{rule}\nDOCUMENT 1 of 2: a.pdf\n{rule}\n\nA\n\n{rule}\nDOCUMENT 2 of 2: b.pdf\n{rule}\n\nB"}
    empty = F.array().cast("array<struct<pos:int,name:string,text:string>>")
    assert spark.range(1).select(I.combine_package(empty)).first()[0] == ""


def test_json_lines(spark, tmp_path):
    path = f"{tmp_path}/seeds.jsonl"
    (tmp_path / "seeds.jsonl").write_text('{"flag": "a", "passage": "x"}\n\n   \n{"flag": "b", "passage": "y"}\n')
    df = I.read_jsonl(spark, f"file://{path}", SEED)
    assert [(r["flag"], r["passage"]) for r in df.orderBy("flag").collect()] == [("a", "x"), ("b", "y")]
    out = f"file://{tmp_path}/out"
    I.write_jsonl(df, out)
    I.write_jsonl(df, out, append=True)
    assert I.read_jsonl(spark, out, SEED).count() == 4
    I.rewrite_jsonl(I.read_jsonl(spark, out, SEED).where("flag = 'a'"), out)
    assert I.read_jsonl(spark, out, SEED).count() == 2
    assert I.backup_once(spark, out, f"file://{tmp_path}/backup/out") and not I.backup_once(spark, out, f"file://{tmp_path}/backup/out")
    (tmp_path / "bad.jsonl").write_text('{"flag": \n')
    with pytest.raises(Exception):
        I.read_jsonl(spark, f"file://{tmp_path}/bad.jsonl", SEED).collect()
    (tmp_path / "p.md").write_text("  a prompt\n")
    assert I.read_prompt(spark, f"file://{tmp_path}/p.md") == "a prompt"
