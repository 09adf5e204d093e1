"""Whole runs: labelling that goes on after failures, evaluation modes, files, commands."""

import sys
import zlib

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tamis import cli
from tamis.operators import metrics as M
from tamis.operators.detection import json_answer
from tamis.plans import evaluation as E
from tamis.plans import labeling as B
from tamis.run_queries import WordDetector, docx_bytes, pdf_bytes
from tamis.schemas import Taxonomy
from tamis.sources import files as W

# executors cannot import this file
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Faulty:
    """Fails for packages named in `down`, answers no JSON for `mute`."""

    def __init__(self, down=(), mute=()):
        self.down, self.mute = down, mute

    def detect(self, prompt):
        text = prompt.rpartition("Text:\n")[2]
        if any(x in text for x in self.down):
            raise ValueError("down")
        return "no JSON" if any(x in text for x in self.mute) else '{"flags": ["8a_set_aside"]}'


def test_failed_calls_are_asked_again_and_answers_are_not(spark, tmp_path):
    packages = spark.createDataFrame([(f"p{i}", f"text of p{i}") for i in range(6)], "rfp_id string, text string")
    path, words = str(tmp_path / "answers"), {"8a_set_aside": "of a program"}
    flags = lambda df: {r["rfp_id"]: r["flags"] for r in df.collect()}
    first = flags(B.propose(packages, lambda: Faulty(down=("p1", "p4"), mute=("p2",)), words, path))
    assert [k for k, v in sorted(first.items()) if not v] == ["p1", "p2", "p4"]
    assert {r["rfp_id"]: r["error"] for r in B.failed(spark, path).collect()} == {"p1": "ValueError: down", "p4": "ValueError: down"}
    assert {r["rfp_id"]: r["attempts"] for r in spark.read.parquet(path).collect()}["p2"] == 3
    # the second run would fail for what is done
    second = flags(B.propose(packages, lambda: Faulty(down=("p0", "p2", "p3", "p5")), words, path))
    assert [k for k, v in sorted(second.items()) if not v] == ["p2"] and B.failed(spark, path).count() == 0
    assert spark.read.parquet(path).count() == 8


@pytest.mark.parametrize("raw,want", [('["a", 1]', ["a"]), ('```json\n{"flags": ["a"]}\n```', ["a"]), ('So: {"flags": []} I think', []), ('{"flags": ["a', None), ("", None), (None, None), ("7", []), ('{"flags": "a"}', [])])
def test_json_answers(raw, want):
    assert json_answer(raw) == want


def test_modes_of_an_evaluation(spark):
    chats = spark.createDataFrame([([("user", "small firms"), ("assistant", "8a_set_aside")],), ([("user", "x"), ("assistant", "no_flag")],)], cli.CHAT)
    good, bad = (lambda: WordDetector({"8a_set_aside": "small"})), (lambda: WordDetector({}))
    assert E.run(chats, Taxonomy(), tuned=good).first()["f1"] == 1.0 and E.run(chats, Taxonomy(), base=bad, mode="base").first()["n_predicted"] == 0
    assert {r["metric"]: r["sign"] for r in E.run(chats, Taxonomy(), bad, good, "compare").collect()}["recall"] == "+"
    for mode, make in (("base", {"tuned": good}), ("compare", {"tuned": good}), ("other", {"tuned": good})):
        with pytest.raises(ValueError):
            E.run(chats, Taxonomy(), mode=mode, **make)


def test_pdf_text_without_a_library():
    assert W.plain_pdf_pages(pdf_bytes(["one (a) \\ b\nline", "", "three"])) == ["one (a) \\ b\nline", "", "three"]
    assert W.pdf_text(pdf_bytes(["one", "", "three"])) == "one\n\nthree"
    packed = zlib.compress(b"BT 0 0 Td [(A)-20(B)-500(C)] TJ T* <4869> Tj (\\051\\n) ' ET")
    body = b"%PDF-1.4\n3 0 obj << /Type /Page /Contents [4 0 R] >> endobj\n4 0 obj << /Filter /FlateDecode >> stream\n" + packed + b"\nendstream endobj\n"
    assert W.plain_pdf_pages(body) == ["AB C\nHi\n)"]
    with pytest.raises(ValueError):
        W.pdf_text(b"text")


def test_a_rewrite_keeps_one_whole_copy(spark, tmp_path):
    path = str(tmp_path / "rows")
    W.write_jsonl(spark.range(5), path)
    W.rewrite_jsonl(W.read_jsonl(spark, path, "id bigint").where("id > 1"), path)
    assert sorted(r["id"] for r in W.read_jsonl(spark, path, "id bigint").collect()) == [2, 3, 4]
    with pytest.raises(Exception):
        W.rewrite_jsonl(W.read_jsonl(spark, path, "id bigint").selectExpr("raise_error('stop') AS id"), path)
    assert W.read_jsonl(spark, path, "id bigint").count() == 3 and not (tmp_path / "rows.old").exists()


def test_a_run_is_counted_on_the_way(spark):
    df, seen = M.observed(spark.range(10), "ten", even=F.col("id") % 2 == 0)
    df.write.format("noop").mode("overwrite").save()
    assert M.throughput(seen, 30.0) == {"rows": 10, "even": 5, "seconds": 30.0, "rows_per_minute": 20.0}


def small():
    return WordDetector({"8a_set_aside": "small"})


class JsonDetector:
    def detect(self, prompt):
        return '{"flags": ["8a_set_aside"]}'


class TwoPassDetector:
    """Proposes two flags for texts with `both`, one for `one`; the check takes one away."""

    def detect(self, prompt):
        text = prompt.rpartition("Text:\n")[2]
        if prompt.startswith("Which of these flags hold"):
            return '{"flags": ["agile_methodology", "oral_presentation"]}'
        return '{"flags": ["8a_set_aside", "agile_methodology"]}' if "both" in text else '["agile_methodology"]' if "one" in text else "[]"


class Asked:
    """Says what context its prompt holds, and flags it."""

    def detect(self, prompt):
        return "agile_methodology" if "Example 1:\nsprints" in prompt else "no_flag"


class Judge:
    def detect(self, prompt):
        return '[{"index": 0, "verdict": "DROP", "reason": "no"}, {"index": 1, "verdict": "FIX", "corrected_flags": ["oral_presentation"]}]'


def test_commands(spark, tmp_path, monkeypatch):
    folder = tmp_path / "in" / "rfp1"
    folder.mkdir(parents=True)
    (folder / "a.docx").write_bytes(docx_bytes("small firms only"))
    (folder / "b.pdf").write_bytes(pdf_bytes(["nothing else"]))
    (folder / "c.txt").write_text("x")
    at, out = str(tmp_path / "in"), str(tmp_path / "out")
    monkeypatch.setattr(cli, "named", lambda path: {"m:json": JsonDetector, "m:small": small}[path])
    assert cli.run(spark, ["screen", at, out, "--detector", "m:small", "--dry-run"]) == {"rows": 2, "rejected": 1}
    assert cli.run(spark, ["screen", at, out, "--detector", "m:small"])["flagged"] == 1
    assert cli.run(spark, ["label", at, out, "--detector", "m:json"])["rows"] == 1
    assert spark.read.json(f"{out}/final").first()["validation"] == "keep"
    with pytest.raises(SystemExit):
        cli.run(spark, ["label", at, out, "--detector", "m:json"])
    assert cli.run(spark, ["label", at, out, "--detector", "m:json", "--resume"])["flagged"] == 1
    rows = spark.createDataFrame([(i, f"r{i}", 0, f"text {i}", ["8a_set_aside"] if i % 2 else [], "high", False, None) for i in range(20)], cli.RECORD)
    W.write_jsonl(rows, f"{out}/records-in")
    counts = cli.run(spark, ["build", f"{out}/records-in", f"{out}/set", "--no-rag", "--exact-split", "--split", "50/25/25"])["counts"]
    assert sum(counts.values()) == 20 and spark.read.json(f"{out}/set/train").count() == 10
    W.write_jsonl(spark.createDataFrame([([("user", "small"), ("assistant", "8a_set_aside")],)], cli.CHAT), f"{out}/chats")
    assert cli.run(spark, ["evaluate", f"{out}/chats", f"{out}/metrics", "--compare", "--base-detector", "m:small", "--tuned-detector", "m:small"])["metrics"][0]["sign"] == ""
    with pytest.raises(SystemExit):
        cli.run(spark, ["evaluate", "a", "b", "--base", "--compare"])


def test_labels_become_a_training_set(spark, tmp_path, monkeypatch):
    for i in range(30):
        folder = tmp_path / "in" / f"rfp{i:02d}"
        folder.mkdir(parents=True)
        (folder / "a.docx").write_bytes(docx_bytes(f"text {i} " + ("both" if i % 3 == 0 else "one" if i % 3 == 1 else "blank")))
    at, out = str(tmp_path / "in"), str(tmp_path / "out")
    monkeypatch.setattr(cli, "named", lambda path: {"m:two": TwoPassDetector, "m:judge": Judge}[path])
    done = cli.run(spark, ["label", at, out, "--detector", "m:two", "--black", "8a_set_aside"])
    assert done["rows"] == 30 and done["flagged"] == 20 and done["proposed"]["flagged"] == 20
    final = {r["rfp_id"]: r for r in spark.read.json(f"{out}/final").collect()}
    assert (final["rfp00"]["flags"], final["rfp00"]["validation"], final["rfp00"]["original_flags"]) == (["agile_methodology"], "fixed", ["8a_set_aside", "agile_methodology"])
    assert final["rfp01"]["validation"] == "keep" and final["rfp02"]["validation"] == "skip"
    assert "pos" not in spark.read.json(f"{out}/final").columns
    for more in ([], ["--no-rag"]):  # records without positions get them
        counts = cli.run(spark, ["build", f"{out}/final", f"{out}/set{len(more)}", "--split", "60/20/20", "--negative-ratio", "0.5", "--exact-split", *more])["counts"]
        kept = 20 - (2 if not more else 0)
        assert sum(n for (_, f), n in counts.items() if f == "agile_methodology") == kept and sum(n for (_, f), n in counts.items() if f == "no_flag") == min(10, kept // 2)
        assert {s for s, _ in counts} == {"train", "eval", "test"}
        assert sum(spark.read.json(f"{out}/set{len(more)}/{s}").count() for s in ("train", "eval", "test")) == sum(counts.values())
    assert cli.run(spark, ["validate", f"{out}/final", f"{out}/judged", "--detector", "m:judge", "--batch-size", "3", "--dry-run"]) == {"rows": 30}
    assert cli.run(spark, ["validate", f"{out}/final", f"{out}/judged", "--detector", "m:judge", "--batch-size", "3", "--limit", "6"])["rows"] == 6
    judged = spark.read.json(f"{out}/judged/validated").groupBy("validation").count().collect()
    assert {r["validation"]: r["count"] for r in judged} == {"dropped": 2, "fixed": 2, "keep": 2}


def test_a_build_without_records_is_an_error(spark, tmp_path):
    W.write_jsonl(spark.createDataFrame([("r", 0, "x", ["8a_set_aside"], "high", False, "dropped")], cli.RECORD.replace("pos bigint, ", "")), str(tmp_path / "rows"))
    with pytest.raises(SystemExit):
        cli.run(spark, ["build", str(tmp_path / "rows"), str(tmp_path / "set"), "--no-rag"])
    (tmp_path / "none").mkdir()
    with pytest.raises(SystemExit):
        cli.run(spark, ["build", str(tmp_path / "none"), str(tmp_path / "set"), "--no-rag"])


def test_labelling_ends_at_its_limits(spark, tmp_path):
    packages = spark.createDataFrame([(f"p{i:02d}", f"text of p{i:02d} " + ("one" if i % 2 else "")) for i in range(40)], "rfp_id string, text string")
    path, words = str(tmp_path / "answers"), {"agile_methodology": "sprints"}
    got = sorted(r["rfp_id"] for r in B.propose_until(packages, TwoPassDetector, words, path, 3, wave=4).collect())
    assert got == [f"p{i:02d}" for i in range(6)] and spark.read.parquet(path).count() == 8  # one wave beyond is not asked
    more = B.propose_until(packages, TwoPassDetector, words, path, 100, wave=16).where("size(flags) > 0").count()
    assert more == 20 and spark.read.parquet(path).count() == 40


def test_limits_and_context_as_commands(spark, tmp_path, monkeypatch):
    for i in range(4):
        folder = tmp_path / "in" / f"rfp{i}"
        folder.mkdir(parents=True)
        (folder / "a.docx").write_bytes(docx_bytes(f"sprints and backlog {i}" if i % 2 else f"the moon {i}"))
    at, out = str(tmp_path / "in"), str(tmp_path / "out")
    monkeypatch.setattr(cli, "named", lambda path: {"m:json": JsonDetector, "m:asked": Asked}[path])
    assert cli.run(spark, ["label", at, out, "--detector", "m:json", "--phase", "1", "--max-rfps", "2"])["rows"] == 2
    assert cli.run(spark, ["label", at, f"{out}2", "--detector", "m:json", "--phase", "1", "--max-flagged", "3"])["rows"] == 3
    assert cli.run(spark, ["label", at, out, "--detector", "m:json", "--phase", "2"])["rows"] == 2
    (tmp_path / "seeds.jsonl").write_text('{"flag": "agile_methodology", "passage": "sprints"}\n{"flag": "oral_presentation", "passage": "the moon at night"}\n')
    common = ["screen", at, "--detector", "m:asked", "--store", str(tmp_path / "store"), "--seeds", str(tmp_path / "seeds.jsonl")]
    assert cli.run(spark, [*common[:2], f"{out}3", *common[2:], "--top-k", "1"])["flagged"] == 2
    assert cli.run(spark, [*common[:2], f"{out}4", *common[2:], "--no-rag", "--max-tokens", "64", "--overlap", "8"])["flagged"] == 0
