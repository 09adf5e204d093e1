import json

import pytest
from pyspark.sql import functions as F

from tamis.functions import parsing as P
from tamis.functions import prompts as R
from tamis.schemas import RUNTIME_TIERS, TIERS, Taxonomy, literals, normalise_records

V = list(RUNTIME_TIERS)


def on(spark, values, expression):
    df = spark.createDataFrame(list(enumerate(values)), "i int, x string").coalesce(1)
    return [r["y"] for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_parse_flags(spark):
    cases = {
        V[0]: [V[0]],
        f"{V[0]}\n{V[1]}": V[:2],
        f"{V[2]}, {V[0]}": [V[2], V[0]],
        f"  {V[0]} ,\n\n {V[1]}\nunknown": V[:2],
        f"{V[0]},{V[0]}": [V[0], V[0]],
        f"no_flag, {V[0]}": [V[0]],
        V[0].upper(): [],
        f"the chunk shows {V[0]}": [],
        "": [], "   ": [], "no_flag": [], "NO_FLAG": [], " none ": [], "None, no_flag": [],
    }
    assert on(spark, list(cases), lambda x: P.parse_flags(x, literals(V))) == list(cases.values())
    assert on(spark, [None], lambda x: P.parse_flags(x, literals(V))) == [[]]


def test_parse_ok_and_format_ok_differ(spark):
    raws = [V[0], "no_flag", "NO_FLAG", "none", "None, no_flag", "prose", "", None, " no_flag\n"]
    assert on(spark, raws, lambda x: P.parse_ok(x, literals(V))) == [True, True, True, True, False, False, False, False, True]
    assert on(spark, raws, lambda x: P.format_ok(x, literals(V))) == [True, True, False, False, False, False, False, False, True]


def test_fences(spark):
    raws = ["```json\n[1]\n```", "```\na\nb", "x", "  ```\na\n```  ", "```", "```json\n```"]
    assert on(spark, raws, P.strip_fence) == ["[1]", "a\nb", "x", "a", "", ""]


def test_json_flags(spark):
    raws = ['{"flags": ["a", "b"]}', 'So: {"flags": ["a"]} ok', '["a"]', '```json\n{"flags": []}\n```', '{"other": 1}', "prose", '{"flags": null}', '{"flags": ["a"', None]
    assert on(spark, raws, P.json_flags) == [["a", "b"], ["a"], ["a"], [], [], [], [], [], []]


def test_json_records_and_verdicts(spark):
    got = on(spark, ['[{"index": 1, "verdict": "FIX", "corrected_flags": ["a"]}]', '{"index": 1}', "x"], P.json_verdicts)
    assert [len(g) for g in got] == [1, 0, 0] and got[0][0]["corrected_flags"] == ["a"] and got[0][0]["reason"] is None


@pytest.mark.parametrize(
    "text,want",
    [('["a", "b"]', ["a", "b"]), ('["a", "b', ["a"]), ('["a", "b", {"c": ["d"]}, "e"', ["a", "b", "e"]), ("```json\n[\"a\\n\"]\n```", ["a\n"]), ("none", None), ("", None), (None, None), ('{"a": 1}', None), ('["a" "b"', ["a", "b"])],
)
def test_salvaged_strings(text, want):
    assert P.salvaged_strings(text) == want


def test_service_text(spark):
    assert on(spark, [json.dumps({"generation": "x\ny", "stop_reason": "stop"}), "{}", "broken"], P.service_text) == ["x\ny", "", ""]


def test_flag_filters_keep_order_and_repetitions(spark):
    df = spark.createDataFrame([(["b", "a", "b", "z"],)], "f array<string>")
    assert df.select(P.in_vocabulary(F.col("f"), literals(["a", "b"]))).first()[0] == ["b", "a", "b"]
    assert df.select(P.only_original(F.col("f"), literals(["z"]))).first()[0] == ["z"]
    ok = lambda t, f: spark.createDataFrame([(t, f)], "t string, f array<string>").select(P.strictly_valid(F.col("t"), F.col("f"), literals(["a"]))).first()[0]
    assert [ok("x", ["a"]), ok("x", []), ok("x", ["b"]), ok(None, ["a"]), ok("x", None)] == [True, True, False, False, False]


def test_label_and_chat(spark):
    df = spark.createDataFrame([("chunk", ["a", "b"]), ("chunk", [])], "t string, f array<string>")
    m = [r[0] for r in df.select(R.chat_record(F.col("t"), F.col("f"), "sys")).collect()]
    assert [[x["role"] for x in r] for r in m] == [["system", "user", "assistant"]] * 2
    assert [r[2]["content"] for r in m] == ["a\nb", "no_flag"]


def test_context_block_and_back(spark):
    df = spark.createDataFrame([(["p1", "p2"], "the chunk")], "p array<string>, c string")
    block = df.select(R.context_block(F.col("p"), F.col("c")).alias("b"))
    assert block.first()[0] == "[Retrieved context]\n\nExample 1:\np1\n\nExample 2:\np2\n\n---\n\nRFP chunk to analyze:\nthe chunk"
    assert block.select(R.extract_chunk(F.col("b"))).first()[0] == "the chunk"
    assert df.select(R.context_block(F.lit(None).cast("array<string>"), F.col("c"))).first()[0] == "[Retrieved context]\n\n---\n\nRFP chunk to analyze:\nthe chunk"
    assert df.select(R.extract_chunk(F.col("c"))).first()[0] == "the chunk"


def test_prompts_hold_what_they_are_given(spark):
    d = F.create_map(F.lit("a"), F.lit("first"), F.lit("b"), F.lit("second"))
    df = spark.createDataFrame([("text", ["a", "b", "c"])], "t string, f array<string>")
    p = df.select(R.flag_check_prompt(F.col("t"), F.col("f"), d, literals(["b"])), R.labelling_prompt(F.col("t"), d), R.extraction_prompt(F.col("t"), literals(["a"]), literals(["b"]), d), R.generation_prompt(F.lit("a"), F.lit("first"), literals(["x"]), F.lit(5)), R.chat_template(F.col("t"), "sys")).first()
    assert "- a: first\n- BLACK b: second" in p[0] and "- c: c" in p[0]
    assert "- a: first\n- b: second" in p[1] and p[1].endswith("text")
    assert "- a: first" in p[2] and "- b" not in p[2]
    assert "5 passages" in p[3] and p[4].startswith("<|begin_of_text|>") and "sys<|eot_id|>" in p[4]
    assert df.select(R.fits_prompt(F.col("t"))).first()[0]


def test_taxonomy(spark):
    t = Taxonomy()
    views = {r["tier"]: r["flags"] for r in t.views(spark).collect()}
    assert sorted(f for v in views.values() for f in v) == sorted(t.flags) and {k: len(v) for k, v in views.items()} == {"red": 2, "blue": 3, "green": 2}
    assert t.of("black") == [] and len(TIERS) == 4
    with pytest.raises(ValueError):
        Taxonomy({"x": "purple"})


def test_missing_columns_of_records_have_their_defaults(spark):
    r = normalise_records(spark.createDataFrame([("1", "text", "more")], "rfp_id string, chunk_text string, extra string")).first()
    assert (r["flags"], r["adversarial"], r["confidence"], r["validation"], r["extra"]) == ([], False, "medium", None, "more")
