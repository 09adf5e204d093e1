"""Sources and sinks: JSON lines, documents in files, packages of documents, prompts, evaluation results."""

from __future__ import annotations

import io
import re
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tamis.functions.text import strip
from tamis.operators.ordinals import shifted
from tamis.workspace import written

SUFFIXES = ("pdf", "docx")
# The frame of a package of several documents.
PACKAGE_HEAD = "MULTI-DOCUMENT PACKAGE ({n} documents)\n\n"
RULE = "=" * 40


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Records of a JSON-lines file or folder, of its current version if rewrite_jsonl has made some; blank lines are skipped, a malformed one fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(current(spark, path))


def read_ordered(spark: SparkSession, path: str, schema: StructType | str, name: str = "pos") -> DataFrame:
    """read_jsonl() with `name`: the place of each record, from 0, in the order of files by name and of lines in them. What the files say about `name` holds if all records do; none is numbered by half."""
    rows = read_jsonl(spark, path, schema)
    if name in rows.columns:
        n, known = rows.agg(F.count("*"), F.count(name)).first()
        if known == n:
            return rows
        if known:
            raise ValueError(f"{n - known} of {n} records have no {name}")
        rows = rows.drop(name)
    at = F.monotonically_increasing_id()
    split = (F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))
    return shifted(written(rows.select("*", *split, at.alias("_at")), "ordered"), ["_file", "_start"], F.col("_at"), name, rows.columns)


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    """One object per line; folders are made. To rewrite what df reads, use rewrite_jsonl."""
    if append:
        df.write.mode("append").json(current(df.sparkSession, path))
    else:
        df.write.mode("overwrite").json(path)


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


# A rewritten folder holds its versions in folders _data-*, and for each a small file _version-* that names the folder. Spark's
# readers pass over names with an underscore in front, so they see no half of anything.
_VERSION, _DATA, _PENDING = "_version-", "_data-", "_pending-"


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, at = _fs(spark, path)
    if not fs.exists(at) or not fs.getFileStatus(at).isDirectory():
        return []
    return sorted(x.getPath().getName() for x in fs.listStatus(at))


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, folder) of the versions of a folder, the current one last."""
    out = []
    for name in _names(spark, path):
        if name.startswith(_VERSION):
            fs, at = _fs(spark, f"{path}/{name}")
            stream = fs.open(at)
            out.append((int(name.removeprefix(_VERSION)), stream.readUTF()))
            stream.close()
    return out


def current(spark: SparkSession, path: str) -> str:
    """Where the records of a path are: its current version, or the path itself if it was never rewritten."""
    path = path.rstrip("/")
    found = _versions(spark, path)
    return f"{path}/{found[-1][1]}" if found else path


def _point(spark: SparkSession, path: str, number: int, folder: str) -> None:
    """Make a folder the current version, by one rename of a written file; an error if another run has made one of that number."""
    fs, draft = _fs(spark, f"{path}/{_PENDING}{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.writeUTF(folder)
    out.close()
    if not fs.rename(draft, _fs(spark, f"{path}/{_VERSION}{number:012d}")[1]):
        raise OSError(f"another run has rewritten {path}")


def _clear(spark: SparkSession, path: str) -> None:
    """Delete what is older than the version before the current one, and what runs that ended midway have left. Readers of the version before may still be at work."""
    found = _versions(spark, path)
    keep = {_VERSION + f"{n:012d}" for n, _ in found[-2:]} | {folder for _, folder in found[-2:]}
    for name in _names(spark, path):
        if name not in keep and (name.startswith((_VERSION, _DATA, _PENDING)) or len(found) > 1):
            fs, at = _fs(spark, f"{path}/{name}")
            fs.delete(at, True)


def rewrite_jsonl(df: DataFrame, path: str) -> None:
    """Replace the records of a folder that df may read. They are written beside the old ones; one rename of a small file makes them the current version, which read_jsonl follows. So a run that ends at any point leaves the old records or the new, whole, and the next one clears up."""
    spark, path = df.sparkSession, path.rstrip("/")
    folder = f"{_DATA}{uuid.uuid4().hex}"
    found = _versions(spark, path)
    df.write.json(f"{path}/{folder}")
    _point(spark, path, found[-1][0] + 1 if found else 1, folder)
    _clear(spark, path)


def backup_once(spark: SparkSession, path: str, to: str) -> bool:
    """Copy the records of a file or folder of JSON lines unless the copy is there; says whether it copied. Executors copy line by line; the copy gets its name last, so one that is there is whole."""
    fs, target = _fs(spark, to)
    if fs.exists(target):
        return False
    draft = f"{to.rstrip('/')}.part"
    spark.read.option("lineSep", "\n").text(current(spark, path)).write.mode("overwrite").option("lineSep", "\n").text(draft)
    if not fs.rename(_fs(spark, draft)[1], target):
        raise OSError(f"cannot name the copy {to}")
    return True


def docx_text(content: bytes) -> str:
    """Non-blank paragraphs of a DOCX body, a blank line between them."""
    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{w}body")
    marks = {f"{w}tab": "\t", f"{w}br": "\n", f"{w}cr": "\n"}
    paragraphs = ("".join(x.text or "" if x.tag == f"{w}t" else marks.get(x.tag, "") for x in p.iter()) for p in body.findall(f"{w}p"))
    return "\n\n".join(p for p in paragraphs if p.strip())


def pdf_text(content: bytes) -> str:
    """Text of the pages that have any, a blank line between them: by the package pypdf where it is installed, else what plain_pdf_pages reads."""
    try:
        from pypdf import PdfReader
    except ImportError:
        pages = plain_pdf_pages(content)
    else:
        pages = [page.extract_text() for page in PdfReader(io.BytesIO(content)).pages]
    return "\n\n".join(p for p in pages if p)


_TOKEN = re.compile(rb"\((?:[^()\\]|\\.)*\)|\[|\]|<[0-9A-Fa-f\s]*>|-?[0-9.]+|[A-Za-z'\"*]+[0-9]*\*?", re.DOTALL)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


def _pdf_string(token: bytes) -> str:
    if token[:1] == b"<":
        digits = re.sub(rb"\s", b"", token[1:-1])
        return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode()).decode("latin-1")
    octal = lambda m: bytes([int(m[1], 8) & 255]) if m[1].isdigit() else b"" if m[1] == b"\n" else _ESCAPES.get(m[1], m[1])
    return re.sub(rb"\\([0-7]{1,3}|.)", octal, token[1:-1], flags=re.DOTALL).decode("latin-1")


def plain_pdf_pages(content: bytes) -> list[str]:
    """Texts of the pages of a PDF in the order of their objects: strings that the content streams show, plain or deflated, in fonts with a Latin encoding. Encrypted files, object streams and other encodings need pypdf."""
    if not content.startswith(b"%PDF"):
        raise ValueError("no PDF")
    if b"/Encrypt" in content or b"/ObjStm" in content:
        raise RuntimeError("reading this PDF needs the package pypdf")
    objects = {int(m[1]): m[2] for m in re.finditer(rb"(?<![0-9])([0-9]+)\s+[0-9]+\s+obj\b(.*?)\bendobj", content, re.DOTALL)}
    pages = []
    for body in objects.values():
        if not re.search(rb"/Type\s*/Page\b", body):
            continue
        named = re.search(rb"/Contents\s*(\[[^\]]*\]|[0-9]+\s+[0-9]+\s+R)", body)
        streams = [objects.get(int(n), b"") for n in re.findall(rb"([0-9]+)\s+[0-9]+\s+R", named[1])] if named else []
        pages.append("".join(_shown(_stream(s)) for s in streams).strip())
    return pages


def _stream(body: bytes) -> bytes:
    head, _, rest = body.partition(b"stream")
    data = rest.rpartition(b"endstream")[0].removeprefix(b"\r").removeprefix(b"\n")
    return zlib.decompressobj().decompress(data) if b"/FlateDecode" in head else data


def _shown(stream: bytes) -> str:
    """What the text operators of a content stream show; a move to another line is a line break, a wide gap in an array a space."""
    out, operands = [], []
    for token in _TOKEN.findall(stream):
        if token[:1] in b"(<[]" or re.fullmatch(rb"-?[0-9.]+", token):
            operands.append(token)
            continue
        if token in (b"T*", b"'", b'"', b"ET") or (token in (b"Td", b"TD") and operands[-1:] not in ([b"0"], [])):
            out.append("\n" if out and out[-1] != "\n" else "")
        if token in (b"Tj", b"'", b'"', b"TJ"):
            out += [_pdf_string(x) if x[:1] in b"(<" else " " for x in operands if x[:1] in b"(<" or (x[:1] == b"-" and token == b"TJ" and float(x) < -200)]
        operands = []
    return "".join(out)


READERS = {"pdf": pdf_text, "docx": docx_text}


def _any_case(suffixes: tuple[str, ...]) -> str:
    """A glob for names with one of the suffixes, in either case."""
    return "*.{" + ",".join("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in x) for x in suffixes) + "}"


def file_contents(spark: SparkSession, path: str, suffixes: tuple[str, ...] = SUFFIXES, recursive: bool = True, stream: bool = False) -> DataFrame:
    """(path, content) of the files below a path that have one of the suffixes; others are passed over when files are listed and never opened. stream: a stream that new files join, folders included. Spark's own reader is used, which reads every store that Spark reads and bounds the bytes of a task by spark.sql.files.maxPartitionBytes."""
    reader = spark.readStream if stream else spark.read
    reader = reader.format("binaryFile").option("pathGlobFilter", _any_case(suffixes)).option("recursiveFileLookup", str(recursive).lower())
    if stream:
        reader = reader.schema("path string, modificationTime timestamp, length bigint, content binary")
    return reader.load(path).select("path", "content")


def extract_files(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """path, folder, name, suffix, text, error of every file below a path; a file that cannot be read has an error and no text. Contents are read of the suffixes that have a reader; of the others the names only."""
    every = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    suffix = F.lower(F.regexp_extract(F.substring_index("path", "/", -1), r"\.([^.]+)$", 1))
    others = every.where(~suffix.isin(*SUFFIXES)).select("path", F.lit(None).cast("binary").alias("content"))
    return extract_contents(file_contents(spark, path, SUFFIXES, recursive).unionByName(others))


def extract_contents(files: DataFrame) -> DataFrame:
    """extract_files() of a table (path, content)."""
    files = files.select("path", "content")

    def extract(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            out = []
            for p, content in zip(pdf["path"], pdf["content"], strict=True):
                folder, _, name = p.rpartition("/")
                found = re.search(r"\.([^.]+)$", name)
                suffix = found[1].lower() if found else ""
                text = error = None
                if suffix in READERS:
                    try:
                        text = READERS[suffix](content)
                    except Exception as e:
                        error = f"{type(e).__name__}: {e}"
                else:
                    error = f"Unsupported file type: .{suffix}"
                out.append((p, folder.rpartition("/")[2], name, suffix, text, error))
            yield pd.DataFrame(out, columns=["path", "folder", "name", "suffix", "text", "error"])

    return files.mapInPandas(extract, "path string, folder string, name string, suffix string, text string, error string")


def discover(files: DataFrame, skip: list[str] = (), excludes: list[str] = (), suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """Files (folder, suffix) of folders that are not hidden, not named in skip and contain no string of excludes."""
    kept = files.where(~F.startswith("folder", F.lit(".")) & F.col("suffix").isin(*suffixes))
    if skip:
        kept = kept.where(~F.col("folder").isin(list(skip)))
    for x in excludes:
        kept = kept.where(~F.contains("folder", F.lit(x)))
    return kept


def folder_texts(files: DataFrame) -> DataFrame:
    """(rfp_id, text): the texts of each folder by name, blank ones and failures left out, a blank line between them."""
    good = files.where(F.col("error").isNull() & (F.trim("text") != ""))
    return good.groupBy(F.col("folder").alias("rfp_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("name", "text"))), lambda s: s["text"]), "\n\n").alias("text"))


def combine_package(sections: Column) -> Column:
    """One text of array<struct<pos, name, text>>, sorted by pos: none is empty, one is its text, several have a head and a numbered frame each."""
    n = F.size(sections)
    ordered = F.array_sort(sections)
    framed = F.transform(ordered, lambda s, i: F.concat(F.lit(RULE + "\nDOCUMENT "), (i + 1).cast("string"), F.lit(" of "), n.cast("string"), F.lit(": "), s["name"], F.lit("\n" + RULE + "\n\n"), s["text"]))
    head, tail = PACKAGE_HEAD.split("{n}")
    many = F.concat(F.lit(head), n.cast("string"), F.lit(tail), F.array_join(framed, "\n\n"))
    return F.when(n == 0, F.lit("")).when(n == 1, F.get(ordered, F.lit(0))["text"]).otherwise(many)


def combine_packages(documents: DataFrame, package_col: str, pos_col: str, name_col: str, text_col: str) -> DataFrame:
    """(package, text): the documents of each package as one text. A package is one text, so it has to fit a row."""
    return documents.groupBy(F.col(package_col).alias("package")).agg(combine_package(F.collect_list(F.struct(F.col(pos_col).alias("pos"), F.col(name_col).alias("name"), F.col(text_col).alias("text")))).alias("text"))


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    """(path, prompt) of every prompt file below a path, without surrounding white space."""
    return spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), strip(F.col("value")).alias("prompt"))


def read_prompt(spark: SparkSession, path: str) -> str:
    """A prompt file without surrounding white space."""
    return read_prompts(spark, path).first()["prompt"]


def write_evaluation(metrics: DataFrame, results: DataFrame, path: str) -> None:
    """metrics (one row) and results (flag sets sorted) as JSON lines below a path."""
    metrics.coalesce(1).write.mode("overwrite").json(f"{path}/metrics")
    results.withColumns({c: F.array_sort(F.array_distinct(c)) for c in ("predicted", "ground_truth")}).write.mode("overwrite").json(f"{path}/results")


def write_debug(detected: DataFrame, path: str) -> None:
    """prompt, raw answer and flags of every chunk."""
    detected.select("prompt", "raw", "flags", "parsed").write.mode("overwrite").json(path)
