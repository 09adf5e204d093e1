"""Rewrites that a run may leave midway, copies, ordinals, files that join a stream."""

import pytest
from pyspark.sql import functions as F

from tamis.operators.ordinals import with_ordinals, zip_strict
from tamis.run_queries import docx_bytes
from tamis.sources import files as W


def ids(spark, path):
    return sorted(r["id"] for r in W.read_jsonl(spark, path, "id bigint").collect())


class Stop(Exception):
    pass


@pytest.mark.parametrize("versions", [0, 1, 3])
@pytest.mark.parametrize("step", ["write", "draft", "point", "clear"])
def test_a_run_that_ends_at_any_step_leaves_whole_records(spark, tmp_path, monkeypatch, versions, step):
    path = f"file://{tmp_path}/rows"
    W.write_jsonl(spark.range(5), path)
    for k in range(versions):
        W.rewrite_jsonl(W.read_jsonl(spark, path, "id bigint").withColumn("id", F.col("id") + 10), path)
    was = [i + 10 * versions for i in range(5)]
    assert ids(spark, path) == was
    rows = W.read_jsonl(spark, path, "id bigint").withColumn("id", F.col("id") * 2)
    after = was
    with monkeypatch.context() as m:
        if step == "write":
            rows = rows.select(F.when(F.col("id") % 2 == 0, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("id"))
        elif step == "draft":
            m.setattr(W, "_point", lambda *a: (_ for _ in ()).throw(Stop()))
        elif step == "point":  # the draft is written, and not yet renamed
            fs = W._fs

            def no_rename(spark, p):
                real, at = fs(spark, p)
                if W._VERSION in p:
                    raise Stop
                return real, at

            m.setattr(W, "_fs", lambda s, p: no_rename(s, p) if f"{versions + 1:012d}" in p else fs(s, p))
        else:
            m.setattr(W, "_clear", lambda *a: (_ for _ in ()).throw(Stop()))
            after = [2 * i for i in was]
        with pytest.raises(Exception):
            W.rewrite_jsonl(rows, path)
    assert ids(spark, path) == after
    W.rewrite_jsonl(W.read_jsonl(spark, path, "id bigint").where("id <> 0"), path)
    assert ids(spark, path) == [i for i in after if i]
    W.write_jsonl(spark.range(100, 102), path, append=True)
    assert ids(spark, path) == [i for i in after if i] + [100, 101]
    left = [p.name for p in (tmp_path / "rows").iterdir() if p.name.startswith("_")]
    assert sum(n.startswith(W._DATA) for n in left) <= 2 and not any(n.startswith(W._PENDING) for n in left)


def test_two_runs_cannot_make_the_same_version(spark, tmp_path):
    path = f"file://{tmp_path}/rows"
    W.write_jsonl(spark.range(3), path)
    W.rewrite_jsonl(spark.range(4), path)
    with pytest.raises(OSError):
        W._point(spark, path, 1, "_data-other")
    assert ids(spark, path) == [0, 1, 2, 3]


def test_a_copy_is_made_by_executors_and_named_last(spark, tmp_path, monkeypatch):
    path, to = f"file://{tmp_path}/rows", f"file://{tmp_path}/backup/rows"
    spark.createDataFrame([("a\r\nb",), ("é  ",), ("",)], "t string").write.json(path)
    assert W.backup_once(spark, path, to) and not W.backup_once(spark, path, to)
    text = lambda p: sorted(r["t"] for r in W.read_jsonl(spark, p, "t string").collect())
    assert text(to) == text(path) and not (tmp_path / "backup" / "rows.part").exists()
    # a copy that an earlier run has begun is no copy
    (tmp_path / "again.part").mkdir()
    (tmp_path / "again.part" / "x.txt").write_text('{"t": "half"}\n')
    assert W.backup_once(spark, path, f"file://{tmp_path}/again") and text(f"file://{tmp_path}/again") == text(path)
    assert "FileUtil" not in open(W.__file__).read()


def test_ordinals_follow_files_and_lines(spark, tmp_path):
    for name, lo, hi in (("b.json", 30, 35), ("a.json", 0, 30), ("c.json", 35, 100)):
        (tmp_path / name).write_text("".join(f'{{"id": {i}}}\n' for i in range(lo, hi)))
    got = W.read_ordered(spark, f"file://{tmp_path}", "id bigint").collect()
    assert all(r["id"] == r["pos"] for r in got) and len(got) == 100
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")  # files in several splits
    try:
        assert all(r["id"] == r["pos"] for r in W.read_ordered(spark, f"file://{tmp_path}", "id bigint").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    half = tmp_path / "half"
    half.mkdir()
    (half / "x.json").write_text('{"id": 1, "pos": 4}\n{"id": 2}\n')
    with pytest.raises(ValueError, match="1 of 2"):
        W.read_ordered(spark, f"file://{half}", "id bigint, pos bigint")
    (half / "x.json").write_text('{"id": 1, "pos": 4}\n')
    assert W.read_ordered(spark, f"file://{half}", "id bigint, pos bigint").first()["pos"] == 4


def test_a_zip_is_strict(spark):
    a = spark.range(10, numPartitions=3).withColumnRenamed("id", "a")
    b = spark.range(10, numPartitions=4).select((F.col("id") * 2).alias("b"))
    assert all(r["b"] == 2 * r["a"] and r["pos"] == r["a"] for r in zip_strict(a, b).collect())
    with pytest.raises(ValueError, match="10 rows cannot be zipped with 9"):
        zip_strict(a, b.where("b < 18"))
    with pytest.raises(ValueError):
        zip_strict(a, a)
    assert zip_strict(a.limit(0), b.limit(0)).count() == 0 and with_ordinals(a, "A").columns == ["A"]


def test_files_of_other_kinds_are_not_read(spark, tmp_path, capsys):
    for name, content in (("r1/a.docx", docx_bytes("one")), ("r1/b.DOCX", docx_bytes("two")), ("r1/big.bin", b"x" * 1000), ("r2/n.pdf.txt", b"x")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)
    got = {r["name"]: r for r in W.extract_files(spark, f"file://{tmp_path}").collect()}
    assert {k: r["text"] for k, r in got.items()} == {"a.docx": "one", "b.DOCX": "two", "big.bin": None, "n.pdf.txt": None}
    assert got["big.bin"]["error"] == "Unsupported file type: .bin"
    read = W.file_contents(spark, f"file://{tmp_path}", ("bin",))
    assert [r["path"].rpartition("/")[2] for r in read.collect()] == ["big.bin"]


def test_new_files_join_a_stream(spark, tmp_path):
    src, out, mark = tmp_path / "in", f"file://{tmp_path}/out", f"file://{tmp_path}/mark"
    (src / "r1").mkdir(parents=True)
    (src / "r1" / "a.docx").write_bytes(docx_bytes("one"))
    (src / "r1" / "n.txt").write_text("x")

    def run():
        rows = W.extract_contents(W.file_contents(spark, f"file://{src}", stream=True)).select("name", "text")
        rows.writeStream.format("json").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
        return sorted((r["name"], r["text"]) for r in spark.read.schema("name string, text string").json(out).collect())

    assert run() == [("a.docx", "one")]
    (src / "r2").mkdir()
    (src / "r2" / "b.docx").write_bytes(docx_bytes("two"))
    assert run() == [("a.docx", "one"), ("b.docx", "two")]
