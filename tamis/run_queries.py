"""Registered queries of sources, sinks, prompts and whole runs, with their equivalents in DuckDB SQL.

What is written goes to the shared folder and is read again, so that a query covers both ways. Files are made of the documents'
own texts: without characters that XML does not hold, or, for PDF, with `?` in place of what is not printable ASCII.
"""

from __future__ import annotations

import io
import json
import re
import uuid
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.functions import parsing as P
from tamis.functions import prompts as R
from tamis.operators import curation as C
from tamis.operators import labeling as L
from tamis.operators import metrics as M
from tamis.operators import retrieval as V
from tamis.operators.detection import ServiceDetector, detect, detect_native, json_answer, lexicon_answer, lexicon_flags, with_prompts
from tamis.operators.ordinals import zip_strict
from tamis.operators.passage_index import PassageIndex
from tamis.operators.sampling import shuffled_by
from tamis.plans import evaluation as E
from tamis.plans import labeling as B
from tamis.plans import screening as S
from tamis.plans import training_set as T
from tamis.queries import _MICRO_SQL, _PAIRS_SQL, _RESULTS_SQL, _vectors, LEXICON, RECORDS_SQL, SETTINGS, VOCABULARY, WEAK_LEXICON, HalfParsingDetector, chunks_sql, definitions, documents, joined, lexicon_sql, query, records, results, table
from tamis.schemas import NO_FLAG, TIERS, Taxonomy, literals
from tamis.sources import files as W
from tamis.workspace import shared_dir


def fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# --- JSON lines --------------------------------------------------------------------------------------------------------


@query("SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars FROM documents")
def q_jsonl_round_trip(spark, sf_dir):
    path = fresh(spark, "jsonl")
    docs = documents(spark, sf_dir)
    W.write_jsonl(docs, path)
    return W.read_jsonl(spark, path, docs.schema).select("doc_id", F.md5("text").alias("text_md5"), "lang", "source", "n_chars")


@query("SELECT conv_id, turn, role, md5(text) AS text_md5 FROM conversations")
def q_jsonl_append(spark, sf_dir):
    path, turns = fresh(spark, "jsonl"), table(spark, sf_dir, "conversations")
    W.write_jsonl(turns.where("turn % 2 = 0"), path, append=True)
    W.write_jsonl(turns.where("turn % 2 <> 0 OR turn IS NULL"), path, append=True)
    return W.read_jsonl(spark, path, turns.schema).select("conv_id", "turn", "role", F.md5("text").alias("text_md5"))


@query("SELECT doc_id, 1 - quality AS quality, toxic FROM labels")
def q_jsonl_rewrite(spark, sf_dir):
    path, labels = fresh(spark, "jsonl"), table(spark, sf_dir, "labels")
    W.write_jsonl(labels, path)
    W.rewrite_jsonl(W.read_jsonl(spark, path, labels.schema).withColumn("quality", 1 - F.col("quality")), path)
    return W.read_jsonl(spark, path, "doc_id bigint, quality int, toxic int").select("doc_id", "quality", "toxic")


@query("SELECT item_id, md5(text) AS text_md5, TRUE AS copied, FALSE AS copied_again FROM benchmark")
def q_backup_once(spark, sf_dir):
    path, items = fresh(spark, "jsonl"), table(spark, sf_dir, "benchmark")
    W.write_jsonl(items, path)
    first = W.backup_once(spark, path, f"{path}-backup")
    W.rewrite_jsonl(W.read_jsonl(spark, path, items.schema).withColumn("text", F.lit("other")), path)
    again = W.backup_once(spark, path, f"{path}-backup")
    return W.read_jsonl(spark, f"{path}-backup", items.schema).select("item_id", F.md5("text").alias("text_md5"), F.lit(first).alias("copied"), F.lit(again).alias("copied_again"))


# --- files -------------------------------------------------------------------------------------------------------------

_NO_XML = r"[\x00-\x08\x0B-\x1F\x{FFFE}\x{FFFF}]"
#: Lines with something on them, a blank line between: what a DOCX of the text's lines holds.
_PARAGRAPHS_SQL = r"array_to_string(list_filter(string_split(regexp_replace(coalesce(text, ''), '[\x00-\x08\x0B-\x1F\x{FFFE}\x{FFFF}]', ' ', 'g'), chr(10)), lambda p: regexp_matches(p, '[^\s\x{85}\x{A0}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{1680}]')), chr(10) || chr(10))"


def docx_bytes(text: str) -> bytes:
    """A DOCX whose paragraphs are the lines of a text."""
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    body = "".join(f'<w:p><w:r><w:t xml:space="preserve">{escape(line)}</w:t></w:r></w:p>' for line in text.split("\n"))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<?xml version="1.0" encoding="UTF-8"?><w:document xmlns:w="{w}"><w:body>{body}</w:body></w:document>'.encode("utf-8", "replace"))
    return out.getvalue()


def pdf_bytes(pages: list[str]) -> bytes:
    """A PDF with a page for each text, a line for each of its lines."""
    quoted = lambda line: line.replace("\\", "\\\\").replace("(", "\\(").replace(")", "\\)")
    kids = " ".join(f"{3 + 2 * k} 0 R" for k in range(len(pages)))
    out = [f"%PDF-1.4\n1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj\n2 0 obj << /Type /Pages /Count {len(pages)} /Kids [{kids}] >> endobj\n"]
    for k, page in enumerate(pages):
        shown = " T*\n".join(f"({quoted(line)}) Tj" for line in page.split("\n"))
        stream = f"BT /F1 11 Tf 14 TL 40 800 Td {shown} ET"
        out.append(f"{3 + 2 * k} 0 obj << /Type /Page /Parent 2 0 R /Contents {4 + 2 * k} 0 R >> endobj\n{4 + 2 * k} 0 obj << /Length {len(stream)} >> stream\n{stream}\nendstream endobj\n")
    return "".join([*out, "trailer << /Root 1 0 R >>\n%%EOF"]).encode("latin-1")


def _files(spark, sf_dir) -> DataFrame:
    """The documents as files (doc_id, path, content): three to a folder, every fifth of a kind that is not read."""

    @F.pandas_udf("binary")
    def docx(texts: pd.Series) -> pd.Series:
        return texts.map(docx_bytes)

    name = F.concat(F.lit("doc"), F.lpad(F.col("doc_id").cast("string"), 9, "0"), F.when(F.col("doc_id") % 5 == 4, F.lit(".txt")).when(F.col("doc_id") % 2 == 0, F.lit(".docx")).otherwise(F.lit(".DOCX")))
    path = F.concat(F.lit("/in/"), F.when(F.col("doc_id") % 11 == 10, F.lit(".")).otherwise(F.lit("")), F.lit("rfp"), F.floor(F.col("doc_id") / 3).cast("string"), F.lit("/"), name)
    text = F.regexp_replace(F.coalesce("text", F.lit("")), _NO_XML, " ")
    return documents(spark, sf_dir).select("doc_id", path.alias("path"), docx(text).alias("content"))


def _extracted(spark, sf_dir) -> DataFrame:
    return W.extract_contents(_files(spark, sf_dir)).withColumn("doc_id", F.regexp_extract("name", "^doc0*([0-9]+)", 1).cast("bigint"))


@query(f"SELECT doc_id, CASE WHEN doc_id % 5 = 4 THEN 'txt' ELSE 'docx' END AS suffix, CASE WHEN doc_id % 5 <> 4 THEN md5({_PARAGRAPHS_SQL}) END AS text_md5, CASE WHEN doc_id % 5 = 4 THEN 'Unsupported file type: .txt' END AS error FROM documents")
def q_extract_files(spark, sf_dir):
    return _extracted(spark, sf_dir).select("doc_id", "suffix", F.md5("text").alias("text_md5"), "error")


@query(f"""
        WITH t AS (SELECT doc_id, CASE WHEN doc_id % 11 = 10 THEN '.' ELSE '' END || 'rfp' || doc_id // 3 AS rfp_id, doc_id % 5 <> 4 AND doc_id % 2 = 0 AS low, {_PARAGRAPHS_SQL} AS p FROM documents WHERE doc_id % 5 <> 4)
        SELECT rfp_id, md5(array_to_string(list(p ORDER BY doc_id), chr(10) || chr(10))) AS text_md5 FROM t WHERE trim(p, ' ') <> '' GROUP BY rfp_id
    """)
def q_folder_corpus(spark, sf_dir):
    return W.folder_texts(_extracted(spark, sf_dir)).select("rfp_id", F.md5("text").alias("text_md5"))


@query("SELECT doc_id, 'rfp' || doc_id // 3 AS folder FROM documents WHERE doc_id % 5 <> 4 AND doc_id % 11 <> 10 AND doc_id // 3 <> 7 AND NOT contains('rfp' || doc_id // 3, '13')")
def q_discover(spark, sf_dir):
    return W.discover(_extracted(spark, sf_dir), skip=["rfp7"], excludes=["13"]).select("doc_id", "folder")


@query(r"""
        WITH t AS (SELECT doc_id, coalesce(source, '') AS a, trim(regexp_replace(coalesce(text, ''), '[^\x20-\x7E\n]', '?', 'g'), ' ' || chr(10)) AS b FROM documents)
        SELECT doc_id, md5(CASE WHEN a = '' THEN b WHEN b = '' THEN a ELSE a || chr(10) || chr(10) || b END) AS text_md5 FROM t
    """)
def q_pdf_text(spark, sf_dir):
    @F.pandas_udf("binary")
    def pdf(sources: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series([pdf_bytes([s, t]) for s, t in zip(sources, texts, strict=True)])

    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"[^\x20-\x7E\n]", "?")
    made = documents(spark, sf_dir).select(F.concat(F.lit("/in/x/"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("path"), pdf(F.coalesce("source", F.lit("")), text).alias("content"))
    return W.extract_contents(made).select(F.substring_index("name", ".", 1).cast("bigint").alias("doc_id"), F.md5("text").alias("text_md5"))


@query(r"SELECT item_id, md5(regexp_replace(text, '^[\s\x{85}\x{A0}\x1C-\x1F]+|[\s\x{85}\x{A0}\x1C-\x1F]+$', '', 'g')) AS prompt_md5 FROM benchmark WHERE item_id IS NOT NULL")
def q_prompt_source(spark, sf_dir):
    """Each text of the benchmark as a prompt file with white space around it."""
    path = fresh(spark, "prompts")
    table(spark, sf_dir, "benchmark").where("item_id IS NOT NULL").select("item_id", F.concat(F.lit("\n  "), "text", F.lit(" \n"))).write.partitionBy("item_id").text(path)
    return W.read_prompts(spark, path).select(F.regexp_extract("path", "item_id=([0-9]+)", 1).cast("bigint").alias("item_id"), F.md5("prompt").alias("prompt_md5"))


@query("SELECT doc_id, source, md5(text) AS text_md5 FROM documents")
def q_zip_strict(spark, sf_dir):
    """Two tables in the same order, put side by side again by position."""
    docs = documents(spark, sf_dir)
    own = docs.orderBy("doc_id").select("doc_id", "source")
    texts = docs.orderBy("doc_id").select(F.md5("text").alias("text_md5"))
    return zip_strict(own, texts).select("doc_id", "source", "text_md5")


@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents")
def q_ordinals(spark, sf_dir):
    """The place of each record in files that bear none."""
    path = fresh(spark, "ordered")
    W.write_jsonl(documents(spark, sf_dir).orderBy("doc_id").select("doc_id", "lang"), path)
    return W.read_ordered(spark, path, "doc_id bigint, lang string").select("doc_id", "pos")


@query(f"WITH {_RESULTS_SQL} {_MICRO_SQL.format(pred='pred')}")
def q_evaluation_sink(spark, sf_dir):
    path, own = fresh(spark, "evaluation"), results(spark, sf_dir)
    W.write_evaluation(M.micro_metrics(own), own, path)
    schema = "n_results bigint, n_predicted bigint, n_truth bigint, n_correct bigint, n_format_ok bigint, `precision` double, recall double, f1 double, format_compliance double"
    return spark.read.schema(schema).json(f"{path}/metrics")


@query(f"WITH {chunks_sql(393, 344)}, c AS (SELECT chunk_text, {lexicon_sql('chunk_text', LEXICON)} AS f FROM chunks) SELECT md5(chunk_text) AS prompt_md5, CASE WHEN len(f) > 0 THEN array_to_string(f, chr(10)) ELSE 'no_flag' END AS raw, array_to_string(f, ',') AS flags FROM c")
def q_debug_sink(spark, sf_dir):
    path = fresh(spark, "debug")
    chunks = with_prompts(S.chunks_of(documents(spark, sf_dir), SETTINGS))
    W.write_debug(detect_native(chunks, lexicon_answer(F.col("prompt"), LEXICON), Taxonomy(), ["prompt"]), path)
    return spark.read.schema("prompt string, raw string, flags array<string>, parsed boolean").json(path).select(F.md5("prompt").alias("prompt_md5"), "raw", joined("flags"))


# --- passages ----------------------------------------------------------------------------------------------------------


def _seeds(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("bigint").alias("pos"), F.lit("seed").alias("flag"), F.col("text").alias("passage"))


@query("SELECT 'seed_' || (row_number() OVER (ORDER BY item_id) - 1) AS id, md5(text) AS passage_md5, (SELECT count(*) FROM benchmark) AS filled, 0 AS filled_again, 0 AS added, (SELECT count(*) FROM benchmark) AS stored FROM benchmark")
def q_passage_store(spark, sf_dir):
    store, seeds = V.PassageStore(spark, fresh(spark, "passages")), _seeds(spark, sf_dir)
    filled, again, added = store.fill_once(lambda: seeds), store.fill_once(lambda: seeds), store.add(seeds)
    counts = {"filled": filled, "filled_again": again, "added": added, "stored": store.count()}
    return store.read().select("id", F.md5("passage").alias("passage_md5"), *(F.lit(n).cast("bigint").alias(c) for c, n in counts.items()))


@query(f"WITH {_PAIRS_SQL} SELECT query_id, CAST(rank AS INTEGER) AS rank, id, round(distance, 6) + 0.0 AS distance FROM r WHERE rank <= 3")
def q_index_topk(spark, sf_dir):
    """The hits of q_vector_topk by a stored index that is filled in two steps."""
    queries, passages = _vectors(spark, sf_dir)
    index = PassageIndex(spark, fresh(spark, "index"))
    rows = passages.select(F.col("id").alias("key"), F.col("id").cast("string").alias("id"), "flag", "passage", "embedding")
    for part in ("key % 3 <> 0", "key % 3 = 0"):
        index.add_vectors(rows.where(part))
    return index.query_vectors(queries, 3).withColumn("distance", F.round("distance", 6) + F.lit(0.0))


@query(r"SELECT item_id AS pos, 64 AS dimensions, CASE WHEN regexp_matches(text, '[\p{L}\p{N}_]') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS norm FROM benchmark")
def q_embedding(spark, sf_dir):
    x = _seeds(spark, sf_dir).select("pos", V.hashed_embedding(F.col("passage")).alias("v"))
    return x.select("pos", F.size("v").alias("dimensions"), F.round(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)), 9).alias("norm"))


@query(f"""
        WITH {chunks_sql(393, 344)}
        SELECT doc_id, chunk_index, md5(CASE WHEN doc_id % 2 = 0 AND source IS NOT NULL THEN '[Retrieved context]' || chr(10) || chr(10) || 'Example 1:' || chr(10) || source || chr(10) || chr(10) || '---' || chr(10) || chr(10) || 'RFP chunk to analyze:' || chr(10) || chunk_text ELSE chunk_text END) AS prompt_md5
        FROM chunks JOIN documents USING (doc_id)
    """)
def q_context_before_inference(spark, sf_dir):
    docs = documents(spark, sf_dir)
    hits = F.when((F.col("doc_id") % 2 == 0) & F.col("source").isNotNull(), F.array("source"))
    chunks = S.chunks_of(docs, SETTINGS).join(docs.select("doc_id", hits.alias("passages")), "doc_id")
    return with_prompts(chunks, F.col("passages")).select("doc_id", "chunk_index", F.md5("prompt").alias("prompt_md5"))


# --- prompts -----------------------------------------------------------------------------------------------------------


@query(f"""
        WITH {RECORDS_SQL}
        SELECT pos, md5('Quote passages that show any of these flags, as a JSON list of {{chunk_text, flags, confidence, adversarial}}.' || chr(10) || '- unknown_flag: unknown_flag' || chr(10) || '- 8a_set_aside: 8a set aside' || chr(10)
            || 'Do not quote passages for: ' || array_to_string(flags, ', ') || chr(10) || chr(10) || 'Text:' || chr(10) || chunk_text) AS prompt_md5 FROM records
    """)
def q_extraction_prompt(spark, sf_dir):
    needed = literals(["unknown_flag", "8a_set_aside"])
    return records(spark, sf_dir).select("pos", F.md5(R.extraction_prompt(F.col("chunk_text"), needed, F.col("flags"), definitions())).alias("prompt_md5"))


@query("SELECT doc_id, md5('Write ' || (doc_id % 5 + 1) || ' passages, as a JSON list of strings, that show ' || source || ' (' || lang || '). Examples:' || chr(10) || text || chr(10) || source) AS prompt_md5 FROM documents")
def q_generation_prompt(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.md5(R.generation_prompt(F.col("source"), F.col("lang"), F.array("text", "source"), F.col("doc_id") % 5 + 1)).alias("prompt_md5"))


@query("SELECT 'x' || n AS name, n <= 600000 AS fits FROM (VALUES (599999), (600000), (600001)) t(n) UNION ALL SELECT 'd' || doc_id, TRUE FROM documents WHERE text IS NOT NULL")
def q_prompt_guard(spark, sf_dir):
    long = spark.createDataFrame([(n,) for n in (599999, 600000, 600001)], "n int").select(F.concat(F.lit("x"), F.col("n").cast("string")).alias("name"), F.expr("repeat('w ', n)").alias("text"))
    both = long.unionByName(documents(spark, sf_dir).where("text IS NOT NULL").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("name"), "text"))
    return both.select("name", R.fits_prompt(F.col("text")).alias("fits"))


# --- detectors ---------------------------------------------------------------------------------------------------------


class Busy(Exception):
    """What the echo service says when it is asked too often."""


def echo_service() -> ServiceDetector:
    """A hosted model that names one flag by a word; every prompt whose length is a multiple of 7 is first refused twice, one whose length is 3 above fails."""
    refused: dict[str, int] = {}

    def invoke(body: str) -> str:
        asked = json.loads(body)
        prompt = asked["prompt"]
        if asked["max_gen_len"] != 64 or asked["temperature"] != 0.1:
            raise AssertionError(body)
        if len(prompt) % 7 == 0:
            refused[prompt] = refused.get(prompt, 0) + 1
            if refused[prompt] % 3:
                raise Busy
        if len(prompt) % 7 == 3:
            raise ValueError("no model")
        return json.dumps({"generation": "hubzone_set_aside" if "license" in prompt.lower() else "no_flag"})

    return ServiceDetector(invoke, is_throttled=lambda e: isinstance(e, Busy), waits=(0, 0, 0))


@query(f"""
        WITH {chunks_sql(393, 344)}
        SELECT doc_id, chunk_index, CASE WHEN length(chunk_text) % 7 = 3 THEN 'ValueError: no model' END AS error, length(chunk_text) % 7 <> 3 AS parsed, CASE WHEN length(chunk_text) % 7 <> 3 AND contains(lower(chunk_text), 'license') THEN 'hubzone_set_aside' ELSE '' END AS flags FROM chunks
    """)
def q_service_detector(spark, sf_dir):
    chunks = with_prompts(S.chunks_of(documents(spark, sf_dir), SETTINGS)).select("doc_id", "chunk_index", "prompt")
    return detect(chunks, echo_service, Taxonomy()).select("doc_id", "chunk_index", "error", "parsed", joined("flags"))


class StutteringDetector:
    """Answers in JSON, for some prompts only the third time, for some never, and fails for some."""

    def __init__(self):
        self.calls: dict[str, int] = {}

    def detect(self, prompt: str) -> str:
        n, kind = self.calls.get(prompt, 0) + 1, len(prompt) % 5
        self.calls[prompt] = n % 3
        if kind == 3:
            raise ValueError("no answer")
        if kind == 2 or (kind == 1 and n < 3):
            return '{"flags": ["hubzone'
        return '```json\n{"flags": ["hubzone_set_aside"]}\n```' if kind == 1 else '["lpta_source_selection"]'


@query(f"""
        WITH {chunks_sql(393, 344)}, c AS (SELECT doc_id, chunk_index, length(chunk_text) % 5 AS k FROM chunks)
        SELECT doc_id, chunk_index, CAST(CASE WHEN k IN (1, 2) THEN 3 ELSE 1 END AS INTEGER) AS attempts, k NOT IN (2, 3) AS parsed, CASE k WHEN 3 THEN 'ValueError: no answer' END AS error,
               CASE WHEN k = 1 THEN 'hubzone_set_aside' WHEN k IN (0, 4) THEN 'lpta_source_selection' ELSE '' END AS flags FROM c
    """)
def q_json_retry(spark, sf_dir):
    chunks = with_prompts(S.chunks_of(documents(spark, sf_dir), SETTINGS)).select("doc_id", "chunk_index", "prompt")
    return detect(chunks, StutteringDetector, Taxonomy(), attempts=3, read=json_answer).select("doc_id", "chunk_index", "attempts", "parsed", "error", joined("flags"))


@query(f"""
        WITH {chunks_sql(393, 344)}, c AS (SELECT doc_id, chunk_index, length(chunk_text) % 4 AS k, {lexicon_sql("chunk_text", LEXICON)} AS f FROM chunks)
        SELECT doc_id, chunk_index, k = 0 AS parsed, CASE k WHEN 3 THEN 'ValueError: no answer' END AS error, CASE WHEN k = 0 THEN array_to_string(f, ',') ELSE '' END AS flags FROM c
    """)
def q_one_attempt(spark, sf_dir):
    chunks = with_prompts(S.chunks_of(documents(spark, sf_dir), SETTINGS)).select("doc_id", "chunk_index", "prompt")
    return detect(chunks, lambda: HalfParsingDetector(attempts=1), Taxonomy(), attempts=1).select("doc_id", "chunk_index", "parsed", "error", joined("flags"))


class WordDetector:
    """The flags whose term a prompt holds, a line each."""

    def __init__(self, lexicon: dict[str, str]):
        self.lexicon = lexicon

    def detect(self, prompt: str) -> str:
        low = prompt.lower()
        return "\n".join(f for f, term in self.lexicon.items() if term in low) or NO_FLAG


@query(f"""
        WITH c AS (SELECT {lexicon_sql("text", LEXICON)} AS f, CASE WHEN contains(lower(text), 'license') THEN 'hubzone_set_aside' WHEN doc_id % 4 = 0 THEN 'lpta_source_selection' ELSE 'no_flag' END AS expected FROM documents WHERE text IS NOT NULL),
        n AS (SELECT count(*) AS cases, count(*) FILTER (contains(CASE WHEN len(f) > 0 THEN array_to_string(f, chr(10)) ELSE 'no_flag' END, expected)) AS passed FROM c)
        SELECT cases, passed, CAST(passed AS DOUBLE) / cases AS rate FROM n
    """)
def q_smoke_cases(spark, sf_dir):
    """The documents as cases, each with what its answer should hold."""
    expected = F.when(F.contains(F.lower("text"), F.lit("license")), "hubzone_set_aside").when(F.col("doc_id") % 4 == 0, "lpta_source_selection").otherwise("no_flag")
    cases = documents(spark, sf_dir).where("text IS NOT NULL").select(F.col("text").alias("prompt"), expected.alias("expected"))
    return M.pass_rate(E.ask_cases(cases, lambda: WordDetector(LEXICON), Taxonomy()))


@query("""
        SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS hour, count(*) AS "rows", count(*) FILTER (event_type = 'error') AS errors, count(*) / 60.0::DOUBLE AS rows_per_minute FROM events WHERE ts IS NOT NULL GROUP BY 1
    """)
def q_throughput(spark, sf_dir):
    rates = M.rates(table(spark, sf_dir, "events"), "ts", "1 hour", errors=F.col("event_type") == "error")
    return rates.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("hour"), "rows", "errors", "rows_per_minute")


@query(f"""
        WITH {RECORDS_SQL}, b AS (SELECT pos, flags, pos // 10 AS batch FROM records),
        v AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY pos) - 1 AS i, batch % 7 = 3 AS down FROM b)
        SELECT pos, CASE WHEN NOT down AND i % 3 = 1 THEN 'agile_methodology' ELSE array_to_string(flags, ',') END AS flags, CASE WHEN NOT down AND i % 3 = 1 THEN 'fixed' WHEN NOT down AND i % 3 = 2 THEN 'dropped' ELSE 'keep' END AS validation, CASE WHEN NOT down AND i % 3 = 2 THEN 'off topic' END AS drop_reason FROM v
    """)
def q_validate_batches(spark, sf_dir):
    """A review of all records, ten to a prompt; the calls of some batches fail."""
    work = records(spark, sf_dir).withColumn("chunk_text", F.concat(F.lit("batch "), F.floor(F.col("pos") / 10).cast("string"), F.lit(" "), F.coalesce("chunk_text", F.lit(""))))
    done = B.validate(work, ReviewingDetector, VOCABULARY, fresh(spark, "reviews"), in_flight=4)
    return done.select("pos", joined("flags"), "validation", "drop_reason")


class ReviewingDetector:
    """Keeps, fixes and drops items by their number in the prompt; fails for every seventh batch."""

    def detect(self, prompt: str) -> str:
        if int(re.search(r"batch ([0-9]+) ", prompt)[1]) % 7 == 3:
            raise ValueError("down")
        items = range(len(re.findall(r"^\[[0-9]+\] flags: ", prompt, re.MULTILINE)))
        verdict = {0: {"verdict": "KEEP"}, 1: {"verdict": "FIX", "corrected_flags": ["agile_methodology", "made_up"]}, 2: {"verdict": "DROP", "reason": "off topic"}}
        return json.dumps([{"index": i, **verdict[i % 3]} for i in items])


# --- whole runs --------------------------------------------------------------------------------------------------------


@query(f"""
        WITH {_RESULTS_SQL}, a AS ({_MICRO_SQL.format(pred="pred")}), b AS ({_MICRO_SQL.format(pred="truth")}),
        x AS (SELECT unnest(['format_compliance', 'precision', 'recall', 'f1']) AS metric, unnest([a.format_compliance, a."precision", a.recall, a.f1]) AS base, unnest([b.format_compliance, b."precision", b.recall, b.f1]) AS tuned FROM a, b)
        SELECT metric, base, tuned, tuned - base AS delta, CASE WHEN tuned - base > 0 THEN '+' ELSE '' END AS sign FROM x
    """)
def q_evaluation_compare(spark, sf_dir):
    chats = documents(spark, sf_dir).select(R.chat_record(F.col("text"), lexicon_flags(F.col("text"), LEXICON)).alias("messages"))
    return E.run(chats, Taxonomy(), base=lambda: WordDetector(WEAK_LEXICON), tuned=lambda: WordDetector(LEXICON), mode="compare")


class SpaceTokenizer:
    def encode(self, text: str) -> list[str]:
        return text.split(" ")


@query("""
        WITH n AS (SELECT length(r) - length(replace(r, ' ', '')) + 1 AS n FROM (
            SELECT '<|start_header_id|>system<|end_header_id|>' || chr(10) || chr(10) || 'Be brief.<|eot_id|><|start_header_id|>user<|end_header_id|>' || chr(10) || chr(10) || text || '<|eot_id|><|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10) || 'no_flag<|eot_id|>' AS r FROM documents)),
        s AS (SELECT list(n ORDER BY n) AS s FROM n)
        SELECT CAST(len(s) AS BIGINT) AS "count", s[1] AS "min", s[len(s)] AS "max", s[least(CAST(floor(len(s) * 0.95::DOUBLE) AS BIGINT), len(s) - 1) + 1] AS p95 FROM s
    """)
def q_token_length_check(spark, sf_dir):
    chats = documents(spark, sf_dir).select(R.chat_record(F.col("text"), literals([]), "Be brief.").alias("messages"))
    stats, _ = E.length_check(chats, SpaceTokenizer)
    return stats.select("count", "min", "max", "p95")


@query("SELECT count(*) // 32 * 3 AS steps, CAST(floor(count(*) // 32 * 3 * 0.1::DOUBLE) AS BIGINT) AS warmup FROM documents")
def q_training_steps(spark, sf_dir):
    steps, warmup = M.training_steps(documents(spark, sf_dir).count(), 4, 8, 3, 0.1)
    return spark.createDataFrame([(steps, warmup)], "steps bigint, warmup bigint")


@query("WITH t AS (SELECT count(*) AS n, CAST(floor(count(*) * 15 / CAST(100 AS DOUBLE)) AS BIGINT) AS e, CAST(floor(count(*) * 10 / CAST(100 AS DOUBLE)) AS BIGINT) AS s FROM documents) SELECT unnest(['train', 'eval', 'test']) AS split, unnest([n - e - s, e, s]) AS n FROM t")
def q_split_targets(spark, sf_dir):
    targets = C.split_targets(documents(spark, sf_dir).count(), "75/15/10")
    return spark.createDataFrame(list(targets.items()), "split string, n bigint")


@query("SELECT doc_id, md5('42|' || doc_id) AS shuffle_key FROM documents")
def q_shuffle(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", shuffled_by(42, "doc_id").alias("shuffle_key")).orderBy("shuffle_key")


@query(f"""
        WITH {RECORDS_SQL}, n AS (SELECT flag, count(*) AS n FROM (SELECT unnest(flags) AS flag FROM records) GROUP BY flag),
        m AS (SELECT flag, n AS missing FROM n WHERE n < 5000)
        SELECT 'SYNTH-' || flag || '-' || printf('%03d', i) AS rfp_id, flag || ' ' || i AS chunk_text, 'synthetic' AS confidence FROM (SELECT flag, unnest(range(0, missing)) AS i FROM m)
    """)
def q_supplement(spark, sf_dir):
    vocabulary = spark.createDataFrame([(f,) for f in VOCABULARY], "flag string")
    rare = C.rare_flags(records(spark, sf_dir), vocabulary, 5000).where("n > 0").select("flag", (F.col("target") - F.col("n")).alias("missing"))
    # batches of five, so that the last one may hold more than is missing
    made = lambda needed: needed.select("flag", F.explode(F.sequence(F.lit(0), F.ceil(F.col("missing") / 5) * 5 - 1)).alias("ordinal")).withColumn("passage", F.concat_ws(" ", "flag", F.col("ordinal").cast("string")))
    return C.supplement(records(spark, sf_dir), made, rare).select("rfp_id", "chunk_text", "confidence")


@query(f"""
        WITH {RECORDS_SQL}, x AS (SELECT DISTINCT pos, unnest(flags) AS flag, validation, confidence FROM records),
        n AS (SELECT flag, count(*) FILTER (validation IS DISTINCT FROM 'dropped') AS n, count(*) FILTER (validation IS DISTINCT FROM 'dropped' AND confidence <> 'synthetic') AS seeds FROM x WHERE flag IN ('hubzone_set_aside', '8a_set_aside') GROUP BY flag)
        SELECT flag, 100000 - n AS missing FROM n WHERE n < 100000 AND seeds >= 2
    """)
def q_oversample(spark, sf_dir):
    return C.oversample_targets(records(spark, sf_dir), ["hubzone_set_aside", "8a_set_aside"], 100000)


@query("SELECT doc_id, 'p' || doc_id // 3 AS rfp_id FROM documents WHERE doc_id // 3 NOT IN (SELECT doc_id // 3 FROM labels WHERE doc_id IS NOT NULL AND doc_id % 3 = 1)")
def q_resume_package(spark, sf_dir):
    package = F.concat(F.lit("p"), F.floor(F.col("doc_id") / 3).cast("string")).alias("rfp_id")
    done = table(spark, sf_dir, "labels").where("doc_id % 3 = 1").select(package)
    return L.not_done(documents(spark, sf_dir).select("doc_id", package), done, ["rfp_id"]).select("doc_id", "rfp_id")


@query("""
        SELECT doc_id, doc_id % 9 = 0 AS failed, CASE WHEN doc_id % 9 = 0 THEN 'x' ELSE '' END || CASE WHEN doc_id % 2 = 0 THEN CASE WHEN doc_id % 9 = 0 THEN ',y' ELSE 'y' END ELSE '' END AS black,
               array_to_string(list_sort(list_distinct([source] || CASE WHEN doc_id % 2 = 0 THEN [source, lang] ELSE [] END)), ',') AS red, CASE WHEN doc_id % 2 = 0 THEN lang ELSE '' END AS green FROM documents
    """)
def q_merge_tiers(spark, sf_dir):
    docs, none = documents(spark, sf_dir), literals([])
    new = docs.select("doc_id", F.when(F.col("doc_id") % 9 == 0, literals(["x"])).otherwise(none).alias("black"), F.array("source").alias("red"), none.alias("green"), *(none.alias(t) for t in TIERS if t not in ("black", "red", "green")))
    old = docs.where("doc_id % 2 = 0").select("doc_id", literals(["y"]).alias("black"), F.array("source", "lang").alias("red"), F.array("lang").alias("green"), *(none.alias(t) for t in TIERS if t not in ("black", "red", "green")))
    return S.merge_tiers(old, new).select("doc_id", "failed", *map(joined, ("black", "red", "green")))


@query(f"""
        WITH cleaned AS (SELECT doc_id, {_PARAGRAPHS_SQL} AS text FROM documents WHERE doc_id % 5 <> 4),
        {chunks_sql(393, 344).replace("FROM documents", "FROM cleaned")},
        flags AS (SELECT doc_id, list_sort(list(DISTINCT flag)) AS flags FROM (SELECT doc_id, unnest({lexicon_sql("chunk_text", LEXICON)}) AS flag FROM chunks) GROUP BY doc_id)
        SELECT doc_id, CASE WHEN doc_id % 5 = 4 THEN 'Unsupported file type: .txt' WHEN trim(c.text, ' ') = '' THEN 'no text' END AS rejected, coalesce(array_to_string(flags, ','), '') AS flags,
               len(list_filter(coalesce(flags, []), lambda x: x IN ('small_business_set_aside', 'lpta_source_selection'))) >= 2 AS filter_out
        FROM documents d LEFT JOIN cleaned c USING (doc_id) LEFT JOIN flags USING (doc_id)
    """)
def q_screen_uploads(spark, sf_dir):
    return S.screen_files(_extracted(spark, sf_dir), lambda c: lexicon_answer(c, LEXICON), SETTINGS, "doc_id").select("doc_id", "rejected", joined("flags"), "filter_out")


@query(f"WITH {RECORDS_SQL} SELECT CAST(count(*) AS BIGINT) AS \"rows\", CAST(count(*) FILTER (len(flags) > 0) AS BIGINT) AS flagged, count(*) * 60 / 90.0::DOUBLE AS rows_per_minute FROM records")
def q_run_log(spark, sf_dir):
    df, seen = M.observed(records(spark, sf_dir).select("pos", "flags"), "run", flagged=C.is_positive())
    df.write.parquet(fresh(spark, "run"))
    log = M.throughput(seen, 90.0)
    return spark.createDataFrame([(log["rows"], log["flagged"], log["rows_per_minute"])], "rows bigint, flagged bigint, rows_per_minute double")


@query(f"""
        WITH {RECORDS_SQL}, kept AS (SELECT * FROM records WHERE validation IS DISTINCT FROM 'dropped' QUALIFY row_number() OVER (PARTITION BY chunk_text ORDER BY pos) = 1),
        p AS (SELECT count(*) FILTER (len(flags) > 0) AS p FROM kept),
        curated AS (SELECT pos, flags FROM kept WHERE len(flags) > 0 UNION ALL SELECT pos, flags FROM (SELECT pos, flags, row_number() OVER (ORDER BY md5('42|' || pos)) AS n FROM kept WHERE len(flags) = 0), p WHERE n <= p),
        n AS (SELECT flag, count(*) AS n FROM (SELECT unnest(flags) AS flag FROM curated) GROUP BY flag),
        s AS (SELECT pos, flags, CAST('0x' || substr(md5('42|' || pos), 1, 6) AS BIGINT) % 100 AS u FROM curated),
        x AS (SELECT CASE WHEN u < 80 THEN 'train' WHEN u < 90 THEN 'eval' ELSE 'test' END AS split, unnest(CASE WHEN len(flags) > 0 THEN flags ELSE ['no_flag'] END) AS flag FROM s)
        SELECT split, flag, count(*) AS n FROM x GROUP BY split, flag
    """)
def q_build_counts(spark, sf_dir):
    return T.build(records(spark, sf_dir), T.TrainingSet(use_context=False)).counts()
