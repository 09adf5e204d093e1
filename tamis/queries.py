"""The registered queries of the engine's own operators, and their equivalents in DuckDB SQL.

The tables stand in for procurement records: documents for packages, labels for judgements, conversations for chat messages,
embeddings for stored passages, events for labelled chunks in order of arrival. Flags come from terms that the texts hold.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.functions import parsing as P
from tamis.functions import prompts as R
from tamis.functions import text as X
from tamis.operators import curation as C
from tamis.operators import labeling as L
from tamis.operators import metrics as M
from tamis.operators import retrieval as V
from tamis.operators.detection import detect, lexicon_answer, lexicon_flags, with_prompts
from tamis.plans import screening as S
from tamis.schemas import RUNTIME_TIERS, Screening, Taxonomy, literals
from tamis.shipping import ship
from tamis.sources.files import combine_packages
from tamis.streaming.quotas import event_quotas, file_stream, gate_quotas, write_gated
from tamis.workspace import shared_dir

#: Terms of the lexicon detector that occur in the tables.
LEXICON = {
    "small_business_set_aside": " the ",
    "lpta_source_selection": " of ",
    "8a_set_aside": " la ",
    "sdvosb_set_aside": " der ",
    "hubzone_set_aside": "license",
    "agile_methodology": " que ",
    "oral_presentation": " und ",
}
#: A second, weaker lexicon, for predictions that differ from the truth.
WEAK_LEXICON = dict(LEXICON, small_business_set_aside=" there ", lpta_source_selection=" of the ", oral_presentation=" und der ")
SETTINGS = Screening(red_threshold=2)
VOCABULARY = list(RUNTIME_TIERS)
SCREENED = ("doc_id", "flags", "unparsed_chunks", "total_chunks", "filter_out")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its name, with the SQL that gives the same rows."""

    def register(f: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def joined(name: str, sep: str = ","):
    return F.array_join(F.col(name), sep).alias(name)


# --- SQL shared by several queries -------------------------------------------------------------------------------------

VOCABULARY_SQL = "[" + ", ".join(f"'{f}'" for f in VOCABULARY) + "]"
WORDS_SQL = r"list_filter(string_split_regex(text, '\s+'), lambda w: w <> '')"


def lexicon_sql(text: str, lexicon: dict[str, str]) -> str:
    """A list of the flags whose term a text holds."""
    return "list_filter([" + ", ".join(f"CASE WHEN contains(lower({text}), '{t}') THEN '{f}' END" for f, t in lexicon.items()) + "], lambda f: f IS NOT NULL)"


def chunks_sql(window: int, step: int) -> str:
    """CTEs up to chunks(doc_id, chunk_index, chunk_text)."""
    return f"""
        w AS (SELECT doc_id, text, {WORDS_SQL} AS ws FROM documents),
        chunks AS (
            SELECT doc_id, CAST(i AS INTEGER) AS chunk_index, CASE WHEN len(ws) <= {window} THEN text ELSE array_to_string(ws[i * {step} + 1 : i * {step} + {window}], ' ') END AS chunk_text
            FROM (SELECT *, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) <= {window} THEN [0] ELSE range(0, CAST(ceil((len(ws) - {window}) / CAST({step} AS DOUBLE)) AS BIGINT) + 1) END) AS i FROM w)
        )"""


SCREEN_SQL = f"""
        WITH {chunks_sql(393, 344)},
        detected AS (SELECT doc_id, {lexicon_sql("chunk_text", LEXICON)} AS f FROM chunks),
        named AS (SELECT doc_id, unnest(f) AS flag FROM detected),
        flags AS (SELECT doc_id, list_sort(list(DISTINCT flag)) AS flags FROM named GROUP BY doc_id),
        n AS (SELECT doc_id, count(*) AS n FROM detected GROUP BY doc_id),
        screened AS (
            SELECT d.doc_id, coalesce(f.flags, []) AS flags, CAST(0 AS BIGINT) AS unparsed_chunks, CAST(coalesce(n.n, 0) AS BIGINT) AS total_chunks,
                   len(list_filter(coalesce(f.flags, []), lambda x: x IN ('small_business_set_aside', 'lpta_source_selection'))) AS reds
            FROM documents d LEFT JOIN flags f USING (doc_id) LEFT JOIN n USING (doc_id)
        )"""

RECORDS_SQL = f"""
        labelled AS (SELECT doc_id, min(quality) AS quality, min(toxic) AS toxic FROM labels GROUP BY doc_id),
        records AS (
            SELECT d.doc_id AS pos, CAST(d.doc_id AS VARCHAR) AS rfp_id, d.text AS chunk_text, {lexicon_sql("d.text", LEXICON)} AS flags,
                   CASE d.n_chars % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'synthetic' END AS confidence, coalesce(l.toxic = 1, false) AS adversarial,
                   CASE l.quality WHEN 0 THEN 'dropped' WHEN 1 THEN 'keep' END AS validation
            FROM documents d LEFT JOIN labelled l USING (doc_id)
        )"""


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as labelled records: pos, rfp_id, chunk_text, flags, confidence, adversarial, validation."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("toxic").alias("toxic"))
    found = lexicon_flags(F.col("text"), LEXICON)
    confidence = F.when(F.col("n_chars") % 3 == 0, "high").when(F.col("n_chars") % 3 == 1, "medium").otherwise("synthetic")
    validation = F.when(F.col("quality") == 0, "dropped").when(F.col("quality") == 1, "keep")
    return documents(spark, sf_dir).join(labels, "doc_id", "left").select(F.col("doc_id").alias("pos"), F.col("doc_id").cast("string").alias("rfp_id"), F.col("text").alias("chunk_text"), found.alias("flags"), confidence.alias("confidence"), F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("adversarial"), validation.alias("validation"))


# --- chunking ----------------------------------------------------------------------------------------------------------


def _digested(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.col("chunk_index").cast("int").alias("chunk_index"), F.md5("chunk_text").alias("chunk_md5"), F.length("chunk_text").cast("bigint").alias("n_chars"))


_DIGEST_SQL = "SELECT doc_id, chunk_index, md5(chunk_text) AS chunk_md5, CAST(length(chunk_text) AS BIGINT) AS n_chars FROM chunks"


@query(f"WITH {chunks_sql(393, 344)} {_DIGEST_SQL}")
def q_chunk_words(spark, sf_dir):
    return _digested(S.chunks_of(documents(spark, sf_dir), SETTINGS))


@query(f"WITH {chunks_sql(49, 37)} {_DIGEST_SQL}")
def q_chunk_small_windows(spark, sf_dir):
    return _digested(S.chunks_of(documents(spark, sf_dir), Screening(max_tokens=64, overlap_tokens=16)))


@query(f"""
        WITH n AS (SELECT doc_id, len({WORDS_SQL}) AS n FROM documents)
        SELECT doc_id, CAST(n AS INTEGER) AS n_words, n * CAST(1.3 AS DOUBLE) AS tokens, CAST(CASE WHEN n = 0 THEN 0 WHEN n <= 393 THEN 1 ELSE 1 + ceil((n - 393) / CAST(344 AS DOUBLE)) END AS INTEGER) AS n_chunks FROM n
    """)
def q_chunk_counts(spark, sf_dir):
    text = F.col("text")
    return documents(spark, sf_dir).select("doc_id", X.word_count(text).alias("n_words"), X.approximate_tokens(text).alias("tokens"), F.size(X.chunk_words(text)).alias("n_chunks"))


@query("""
        WITH c AS (
            SELECT doc_id, text, unnest(CASE WHEN trim(text) = '' THEN [] WHEN length(text) <= 2000 THEN [0] ELSE range(0, CAST(ceil((length(text) - 2000) / CAST(1800 AS DOUBLE)) AS BIGINT) + 1) END) AS i FROM documents
        ), chunks AS (SELECT doc_id, CAST(i AS INTEGER) AS chunk_index, CASE WHEN length(text) <= 2000 THEN text ELSE substr(text, i * 1800 + 1, 2000) END AS chunk_text FROM c)
        """ + _DIGEST_SQL)
def q_chunk_chars(spark, sf_dir):
    return _digested(documents(spark, sf_dir).select("doc_id", F.posexplode(X.chunk_characters(F.col("text"), 2000, 200)).alias("chunk_index", "chunk_text")))


class CharacterTokenizer:
    """One token per character."""

    def encode(self, text: str) -> list[str]:
        return list(text)

    def decode(self, ids: list[str]) -> str:
        return "".join(ids)


@query(ORACLES["q_chunk_chars"])
def q_chunk_tokens(spark, sf_dir):
    return _digested(documents(spark, sf_dir).select("doc_id", F.posexplode(X.chunk_tokens(CharacterTokenizer, 2000, 200)(F.col("text"))).alias("chunk_index", "chunk_text")))


# the chunks of paragraph folds: a step per paragraph, all documents at once
_PARAGRAPHS_SQL = r"""
        p AS (SELECT doc_id, text, list_transform(string_split(text, chr(10)), lambda x: {'p': x, 'w': list_filter(string_split_regex(x, '\s+'), lambda w: w <> '')}) AS ps FROM documents)"""


@query(f"""
        WITH RECURSIVE {_PARAGRAPHS_SQL}, q AS (SELECT doc_id, list_filter(ps, lambda x: len(x.w) > 0) AS ps FROM p), start AS (
            SELECT doc_id, 1 AS i, ps, CAST([] AS VARCHAR[]) AS chunks, list_slice(ps, 1, 0) AS cur FROM q
        ), r AS (
            SELECT * FROM start
            UNION ALL
            SELECT doc_id, i + 1, ps, CASE WHEN over THEN list_append(chunks, array_to_string(list_transform(cur, lambda x: x.p), chr(10))) ELSE chunks END,
                   list_append(CASE WHEN over THEN list_slice(cur, len(cur) - k + 1, len(cur)) ELSE cur END, ps[i])
            FROM (SELECT *, len(cur) > 0 AND list_sum(list_transform(cur, lambda x: len(x.w))) + len(ps[i].w) > 400 AS over,
                         list_max(list_filter(range(0, len(cur) + 1), lambda k: coalesce(list_sum(list_transform(list_slice(cur, len(cur) - k + 1, len(cur)), lambda x: len(x.w))), 0) <= 50)) AS k
                  FROM r WHERE i <= len(ps))
        ), done AS (SELECT doc_id, CASE WHEN len(cur) > 0 THEN list_append(chunks, array_to_string(list_transform(cur, lambda x: x.p), chr(10))) ELSE chunks END AS c FROM r WHERE i = len(ps) + 1),
        chunks AS (SELECT doc_id, CAST(unnest(range(0, len(c))) AS INTEGER) AS chunk_index, unnest(c) AS chunk_text FROM done)
        """ + _DIGEST_SQL)
def q_pack_paragraphs(spark, sf_dir):
    return _digested(documents(spark, sf_dir).select("doc_id", F.posexplode(X.pack_paragraphs(F.col("text"), 400, 50, "\n")).alias("chunk_index", "chunk_text")))


@query(f"""
        WITH RECURSIVE {_PARAGRAPHS_SQL}, start AS (
            SELECT doc_id, 1 AS i, ps, CAST([] AS VARCHAR[]) AS chunks, list_slice(ps, 1, 0) AS cur FROM p WHERE list_sum(list_transform(ps, lambda x: len(x.w))) > 300
        ), r AS (
            SELECT * FROM start
            UNION ALL
            SELECT doc_id, i + 1, ps, list_concat(CASE WHEN flush THEN list_append(chunks, array_to_string(list_transform(cur, lambda x: x.p), chr(10))) ELSE chunks END, CASE WHEN hard THEN list_transform(range(0, len(ps[i].w), 300), lambda j: array_to_string(list_slice(ps[i].w, j + 1, j + 300), ' ')) ELSE [] END),
                   CASE WHEN hard THEN list_slice(cur, 1, 0) WHEN flush THEN [ps[i]] ELSE list_append(cur, ps[i]) END
            FROM (SELECT *, len(ps[i].w) > 300 AS hard, len(cur) > 0 AND coalesce(list_sum(list_transform(cur, lambda x: len(x.w))), 0) + len(ps[i].w) > 300 AS flush FROM r WHERE i <= len(ps))
        ), done AS (
            SELECT doc_id, CASE WHEN len(cur) > 0 THEN list_append(chunks, array_to_string(list_transform(cur, lambda x: x.p), chr(10))) ELSE chunks END AS c FROM r WHERE i = len(ps) + 1
            UNION ALL SELECT doc_id, [text] FROM p WHERE list_sum(list_transform(ps, lambda x: len(x.w))) <= 300
        ), chunks AS (SELECT doc_id, CAST(unnest(range(0, len(c))) AS INTEGER) AS chunk_index, unnest(c) AS chunk_text FROM done)
        """ + _DIGEST_SQL)
def q_split_sections(spark, sf_dir):
    return _digested(documents(spark, sf_dir).select("doc_id", F.posexplode(X.split_sections(F.col("text"), 300, "\n")).alias("chunk_index", "chunk_text")))


# --- parsing -----------------------------------------------------------------------------------------------------------

RAW_SQL = f"""
        raws AS (
            SELECT conv_id, turn, CASE turn % 5
                WHEN 0 THEN array_to_string({lexicon_sql("text", LEXICON)}, chr(10))
                WHEN 1 THEN '  ' || array_to_string({lexicon_sql("text", LEXICON)}, ' , ') || ' ,other'
                WHEN 2 THEN ' No_Flag ' WHEN 3 THEN 'None, no_flag' ELSE text END AS raw
            FROM conversations
        ), parsed AS (
            SELECT conv_id, turn, raw, lower(trim(raw, ' ' || chr(10))) AS low, list_filter(list_transform(string_split_regex(raw, '[\\n,]+'), lambda x: trim(x, ' ' || chr(10))), lambda x: list_contains({VOCABULARY_SQL}, x)) AS f
            FROM raws
        )"""


def _raws(spark, sf_dir):
    k = F.col("turn") % 5
    raw = F.when(k == 0, F.array_join(lexicon_flags(F.col("text"), LEXICON), "\n")).when(k == 1, F.concat(F.lit("  "), F.array_join(lexicon_flags(F.col("text"), LEXICON), " , "), F.lit(" ,other"))).when(k == 2, F.lit(" No_Flag ")).when(k == 3, F.lit("None, no_flag")).otherwise(F.col("text"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", raw.alias("raw"))


@query(f"WITH {RAW_SQL} SELECT conv_id, turn, array_to_string(CASE WHEN low IN ('no_flag', 'none') THEN [] ELSE f END, '|') AS flags FROM parsed")
def q_parse_flags(spark, sf_dir):
    return _raws(spark, sf_dir).select("conv_id", "turn", F.array_join(P.parse_flags(F.col("raw"), literals(VOCABULARY)), "|").alias("flags"))


@query(f"WITH {RAW_SQL} SELECT conv_id, turn, len(f) > 0 OR low IN ('no_flag', 'none') AS ok FROM parsed")
def q_parse_ok(spark, sf_dir):
    return _raws(spark, sf_dir).select("conv_id", "turn", P.parse_ok(F.col("raw"), literals(VOCABULARY)).alias("ok"))


@query(f"WITH {RAW_SQL} SELECT conv_id, turn, len(f) > 0 OR trim(raw, ' ' || chr(10)) = 'no_flag' AS ok FROM parsed")
def q_format_ok(spark, sf_dir):
    return _raws(spark, sf_dir).select("conv_id", "turn", P.format_ok(F.col("raw"), literals(VOCABULARY)).alias("ok"))


@query(f"WITH {RECORDS_SQL} SELECT pos, CASE WHEN len(flags) > 0 THEN array_to_string(flags, chr(10)) ELSE 'no_flag' END AS label FROM records")
def q_label_render(spark, sf_dir):
    return records(spark, sf_dir).select("pos", P.render_label(F.col("flags")).alias("label"))


_FENCED_SQL = "CASE WHEN event_id % 3 = 0 THEN '```json' || chr(10) || props || chr(10) || '```' WHEN event_id % 3 = 1 THEN '```' || chr(10) || props ELSE '  ' || props END"


def _fenced(spark, sf_dir):
    k, fence = F.col("event_id") % 3, F.lit("```")
    raw = F.when(k == 0, F.concat(F.lit("```json\n"), "props", F.lit("\n"), fence)).when(k == 1, F.concat(fence, F.lit("\n"), "props")).otherwise(F.concat(F.lit("  "), "props"))
    return table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", raw.alias("raw"))


@query("SELECT event_id, trim(props, ' ' || chr(10)) AS body FROM events")
def q_fence_strip(spark, sf_dir):
    return _fenced(spark, sf_dir).select("event_id", P.strip_fence(F.col("raw")).alias("body"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_type || '|x' WHEN 1 THEN event_type ELSE '' END AS flags FROM events")
def q_json_flags(spark, sf_dir):
    k, name = F.col("event_id") % 4, F.col("event_type")
    raw = F.when(k == 0, F.concat(F.lit('Here: {"flags": ["'), name, F.lit('", "x"]} as asked'))).when(k == 1, F.concat(F.lit('```json\n["'), name, F.lit('"]\n```'))).when(k == 2, F.lit('{"flags": null}')).otherwise(F.lit('{"flags": ["cut'))
    return table(spark, sf_dir, "events").select("event_id", F.array_join(P.json_flags(raw), "|").alias("flags"))


@query("SELECT event_id, CAST(CASE WHEN event_id % 2 = 0 THEN 2 ELSE 0 END AS INTEGER) AS n, CASE WHEN event_id % 2 = 0 THEN event_type END AS chunk_text, CASE WHEN event_id % 2 = 0 THEN 'a|b' END AS flags FROM events")
def q_json_records(spark, sf_dir):
    raw = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('```\n[{"chunk_text": "'), "event_type", F.lit('", "flags": ["a", "b"]}, {"confidence": "low"}]\n```'))).otherwise(F.lit('{"chunk_text": "no list"'))
    found = table(spark, sf_dir, "events").select("event_id", P.json_records(raw).alias("r"))
    first = F.get("r", F.lit(0))
    return found.select("event_id", F.size("r").alias("n"), first["chunk_text"].alias("chunk_text"), F.array_join(first["flags"], "|").alias("flags"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 2 THEN '' ELSE event_type || '|' || user_id || CASE WHEN event_id % 3 = 0 THEN '|z' ELSE '' END END AS strings FROM events")
def q_salvage_strings(spark, sf_dir):
    k = F.col("event_id") % 3
    head = F.concat(F.lit('["'), "event_type", F.lit('", "'), F.col("user_id").cast("string"), F.lit('", "z'))
    raw = F.when(k == 0, F.concat(head, F.lit('"]'))).when(k == 1, head).otherwise(F.lit("nothing of the kind"))
    return table(spark, sf_dir, "events").select("event_id", F.coalesce(F.array_join(P.salvage_strings(raw), "|"), F.lit("")).alias("strings"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type ELSE '' END AS generation FROM events")
def q_service_text(spark, sf_dir):
    body = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"generation": "'), "event_type", F.lit('", "stop_reason": "stop"}'))).otherwise(F.lit('{"stop_reason": "length"}'))
    return table(spark, sf_dir, "events").select("event_id", P.service_text(body).alias("generation"))


# --- prompts and chat records ------------------------------------------------------------------------------------------


@query("SELECT doc_id, md5('[Retrieved context]' || chr(10) || chr(10) || 'Example 1:' || chr(10) || source || chr(10) || chr(10) || 'Example 2:' || chr(10) || lang || chr(10) || chr(10) || '---' || chr(10) || chr(10) || 'RFP chunk to analyze:' || chr(10) || text) AS prompt_md5 FROM documents")
def q_rag_prompt(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.md5(R.context_block(F.array("source", "lang"), F.col("text"))).alias("prompt_md5"))


@query("""
        SELECT doc_id, md5('<|begin_of_text|><|start_header_id|>system<|end_header_id|>' || chr(10) || chr(10) || 'Be brief.<|eot_id|><|start_header_id|>user<|end_header_id|>' || chr(10) || chr(10)
            || text || '<|eot_id|><|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10)) AS prompt_md5 FROM documents
    """)
def q_chat_template(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.md5(R.chat_template(F.col("text"), "Be brief.")).alias("prompt_md5"))


@query("SELECT doc_id, md5(text) AS chunk_md5 FROM documents")
def q_extract_chunk(spark, sf_dir):
    text = F.col("text")
    prompt = F.when(F.col("doc_id") % 2 == 0, R.context_block(F.array("source"), text)).otherwise(text)
    return documents(spark, sf_dir).select("doc_id", F.md5(R.extract_chunk(prompt)).alias("chunk_md5"))


@query(f"WITH {RECORDS_SQL} SELECT pos, CAST(3 AS INTEGER) AS n_messages, 'system,user,assistant' AS roles, md5(chunk_text) AS user_md5, CASE WHEN len(flags) > 0 THEN array_to_string(flags, chr(10)) ELSE 'no_flag' END AS answer FROM records")
def q_chat_records(spark, sf_dir):
    chats = records(spark, sf_dir).select("pos", R.chat_record(F.col("chunk_text"), F.col("flags")).alias("m"))
    return chats.select("pos", F.size("m").alias("n_messages"), F.array_join(F.transform("m", lambda x: x["role"]), ",").alias("roles"), F.md5(R.first_content(F.col("m"), "user")).alias("user_md5"), R.first_content(F.col("m"), "assistant").alias("answer"))


@query("""
        WITH m AS (SELECT conv_id, list({'turn': turn, 'role': role, 'text': text} ORDER BY turn) AS m FROM conversations GROUP BY conv_id)
        SELECT conv_id, CAST(len(list_filter(m, lambda x: x.role IN ('system', 'user'))) AS INTEGER) AS n_kept, md5(list_filter(m, lambda x: x.role = 'assistant')[1].text) AS label_md5 FROM m
    """)
def q_role_projection(spark, sf_dir):
    chats = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("m"))
    return chats.select("conv_id", F.size(R.of_roles(F.col("m"), "system", "user")).alias("n_kept"), F.md5(R.first_content(F.col("m"), "assistant")).alias("label_md5"))


_DEFINITIONS = {f: f.replace("_", " ") for f in VOCABULARY}


def definitions():
    return F.create_map(*(F.lit(x) for pair in _DEFINITIONS.items() for x in pair))


@query("SELECT doc_id, md5('Which of these flags does the text show? Answer {\"flags\": [...]}.' || chr(10) || '" + "' || chr(10) || '".join(f"- {f}: {d}" for f, d in _DEFINITIONS.items()) + "' || chr(10) || chr(10) || 'Text:' || chr(10) || text) AS prompt_md5 FROM documents")
def q_labelling_prompt(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.md5(R.labelling_prompt(F.col("text"), definitions())).alias("prompt_md5"))


@query(f"""
        WITH {RECORDS_SQL}, lines AS (SELECT pos, chunk_text, list_transform(flags, lambda f: '- ' || CASE WHEN f = 'lpta_source_selection' THEN 'BLACK ' ELSE '' END || f || ': ' || replace(f, '_', ' ')) AS l FROM records WHERE len(flags) > 0)
        SELECT pos, md5('Which of these flags hold for the text? Answer {{"flags": [...]}}.' || chr(10) || array_to_string(l, chr(10)) || chr(10) || chr(10) || 'Text:' || chr(10) || chunk_text) AS prompt_md5 FROM lines
    """)
def q_flag_check_prompt(spark, sf_dir):
    own = records(spark, sf_dir).where(C.is_positive())
    return own.select("pos", F.md5(R.flag_check_prompt(F.col("chunk_text"), F.col("flags"), definitions(), literals(["lpta_source_selection"]))).alias("prompt_md5"))


@query(f"""
        WITH {RECORDS_SQL}, items AS (
            SELECT CAST(floor(pos / 10) AS BIGINT) AS batch_id, list('[' || (pos % 10) || '] flags: ' || array_to_string(flags, ', ') || '; confidence: ' || confidence || '; adversarial: ' || CASE WHEN adversarial THEN 'true' ELSE 'false' END || chr(10) || chunk_text ORDER BY pos) AS l
            FROM records GROUP BY 1
        ) SELECT batch_id, md5('Judge each item: KEEP, FIX with corrected_flags, or DROP with a reason, as a JSON list of {{index, verdict, corrected_flags, reason}}.' || chr(10) || chr(10) || array_to_string(l, chr(10) || chr(10))) AS prompt_md5 FROM items
    """)
def q_validation_prompt(spark, sf_dir):
    items = records(spark, sf_dir).groupBy(F.floor(F.col("pos") / 10).cast("bigint").alias("batch_id")).agg(F.array_sort(F.collect_list(F.struct("pos", "chunk_text", "flags", "confidence", "adversarial"))).alias("items"))
    return items.select("batch_id", F.md5(R.validation_prompt(F.col("items"))).alias("prompt_md5"))


# --- screening ---------------------------------------------------------------------------------------------------------


def _screened(spark, sf_dir):
    return S.screen_answers(documents(spark, sf_dir), lambda c: lexicon_answer(c, LEXICON), SETTINGS)


@query(f"{SCREEN_SQL} SELECT doc_id, array_to_string(flags, ',') AS flags, unparsed_chunks, total_chunks, reds >= 2 AS filter_out FROM screened")
def q_screen_documents(spark, sf_dir):
    return _screened(spark, sf_dir).select("doc_id", joined("flags"), "unparsed_chunks", "total_chunks", "filter_out")


@query(f"""{SCREEN_SQL} SELECT doc_id, '' AS black,
        array_to_string(list_sort(list_filter(flags, lambda f: f IN ('small_business_set_aside', 'lpta_source_selection'))), ',') AS red,
        array_to_string(list_sort(list_filter(flags, lambda f: f IN ('agile_methodology', 'oral_presentation'))), ',') AS green,
        array_to_string(list_sort(list_filter(flags, lambda f: f IN ('8a_set_aside', 'sdvosb_set_aside', 'hubzone_set_aside'))), ',') AS blue,
        unparsed_chunks, total_chunks FROM screened""")
def q_screen_by_tier(spark, sf_dir):
    tiers = S.screen_by_tier(_screened(spark, sf_dir), Taxonomy())
    return tiers.select("doc_id", *(joined(t) for t in ("black", "red", "green", "blue")), "unparsed_chunks", "total_chunks")


@query(f"{SCREEN_SQL} SELECT doc_id, CAST(t AS INTEGER) AS threshold, reds >= t AS filter_out FROM screened, (VALUES (1), (2), (3)) v(t)")
def q_threshold_sweep(spark, sf_dir):
    flags = F.col("flags")
    sweep = F.array(*(F.struct(F.lit(t).alias("threshold"), S.filters_out(flags, Taxonomy(), t).alias("filter_out")) for t in (1, 2, 3)))
    return _screened(spark, sf_dir).select("doc_id", F.inline(sweep))


@query(f"""{SCREEN_SQL} SELECT doc_id, CASE WHEN reds >= 2 THEN 'FILTER: ' ELSE 'PASS: ' END || CASE WHEN len(flags) > 0 THEN array_to_string(flags, ', ') ELSE 'no flags' END || ' in ' || total_chunks || ' chunks, 0 unparsed' AS report FROM screened""")
def q_screen_report(spark, sf_dir):
    return S.report(_screened(spark, sf_dir))


class HalfParsingDetector:
    """Answers that fail for texts of some lengths: never parsed, parsed at the second attempt of those that a chunk has, or an exception."""

    def __init__(self, attempts: int = 2):
        self.attempts, self.seen, self.calls = attempts, None, 0

    def detect(self, chunk: str) -> str:
        kind = len(chunk) % 4
        self.calls = self.calls + 1 if self.seen == chunk and self.calls < self.attempts else 1
        self.seen = chunk
        if kind == 3:
            raise ValueError("no answer")
        if kind == 1 or (kind == 2 and self.calls == 1):
            return "cannot tell"
        self.seen = None  # an equal chunk after this one begins anew
        return "\n".join(f for f, t in LEXICON.items() if t in chunk.lower()) or "no_flag"


_RETRY_SQL = f"""
        WITH {chunks_sql(393, 344)}, c AS (SELECT doc_id, length(chunk_text) % 4 AS k, {lexicon_sql("chunk_text", LEXICON)} AS f FROM chunks),
        named AS (SELECT doc_id, list_sort(list(DISTINCT flag)) AS flags FROM (SELECT doc_id, unnest(f) AS flag FROM c WHERE k IN (0, 2)) GROUP BY doc_id),
        n AS (SELECT doc_id, count(*) AS total, count(*) FILTER (k IN (1, 3)) AS unparsed FROM c GROUP BY doc_id)
        SELECT d.doc_id, coalesce(array_to_string(flags, ','), '') AS flags, CAST(coalesce(unparsed, 0) AS BIGINT) AS unparsed_chunks, CAST(coalesce(total, 0) AS BIGINT) AS total_chunks,
               len(list_filter(coalesce(flags, []), lambda x: x IN ('small_business_set_aside', 'lpta_source_selection'))) >= 2 AS filter_out
        FROM documents d LEFT JOIN named USING (doc_id) LEFT JOIN n USING (doc_id)"""


@query(_RETRY_SQL)
def q_unparsed_retry(spark, sf_dir):
    return S.screen(documents(spark, sf_dir), HalfParsingDetector, SETTINGS).select("doc_id", joined("flags"), "unparsed_chunks", "total_chunks", "filter_out")


@query(f"""
        WITH {chunks_sql(393, 344)}, c AS (SELECT doc_id, chunk_index, length(chunk_text) % 4 AS k, {lexicon_sql("chunk_text", LEXICON)} AS f FROM chunks)
        SELECT doc_id, chunk_index, CAST(CASE k WHEN 1 THEN 2 WHEN 2 THEN 2 ELSE 1 END AS INTEGER) AS attempts, k IN (0, 2) AS parsed, CASE k WHEN 3 THEN 'ValueError: no answer' END AS error, CASE WHEN k IN (0, 2) THEN array_to_string(f, ',') ELSE '' END AS flags FROM c
    """)
def q_detect_chunks(spark, sf_dir):
    chunks = with_prompts(S.chunks_of(documents(spark, sf_dir), SETTINGS)).select("doc_id", "chunk_index", "prompt")
    return detect(chunks, HalfParsingDetector, Taxonomy()).select("doc_id", "chunk_index", "attempts", "parsed", "error", joined("flags"))


@query(f"""
        WITH {RECORDS_SQL}, t AS (SELECT * FROM (VALUES {", ".join(f"('{f}', '{t}')" for f, t in RUNTIME_TIERS.items())}) v(flag, tier)),
        n AS (SELECT flag, count(*) AS n FROM (SELECT unnest(flags) AS flag FROM records) GROUP BY flag)
        SELECT tier, string_agg(flag, ',' ORDER BY flag) AS flags, CAST(coalesce(sum(n), 0) AS BIGINT) AS n FROM t LEFT JOIN n USING (flag) GROUP BY tier
    """)
def q_taxonomy_views(spark, sf_dir):
    """The flags of each tier, and how often records show one of them."""
    known = Taxonomy()
    shown = records(spark, sf_dir).select(F.explode("flags").alias("flag")).join(known.table(spark), "flag").groupBy("tier").agg(F.count("*").alias("n"))
    return known.views(spark).join(shown, "tier", "left").select("tier", joined("flags"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


# --- record filters and statistics -------------------------------------------------------------------------------------

KNOWN = VOCABULARY[:4]
KNOWN_SQL = "[" + ", ".join(f"'{f}'" for f in KNOWN) + "]"


@query(f"WITH {RECORDS_SQL} SELECT pos, array_to_string(list_filter(flags, lambda f: list_contains({KNOWN_SQL}, f)), ',') AS flags FROM records")
def q_strip_unknown(spark, sf_dir):
    return C.strip_unknown_flags(records(spark, sf_dir), literals(KNOWN)).select("pos", joined("flags"))


@query(f"WITH {RECORDS_SQL} SELECT pos FROM records WHERE len(list_filter(flags, lambda f: NOT list_contains({KNOWN_SQL}, f))) = 0")
def q_strict_validate(spark, sf_dir):
    return records(spark, sf_dir).where(P.strictly_valid(F.col("chunk_text"), F.col("flags"), literals(KNOWN))).select("pos")


@query(f"WITH {RECORDS_SQL} SELECT pos, validation FROM records WHERE validation IS DISTINCT FROM 'dropped'")
def q_drop_rejected(spark, sf_dir):
    return C.drop_rejected(records(spark, sf_dir)).select("pos", "validation")


@query(f"WITH {RECORDS_SQL} SELECT pos FROM records WHERE validation IS DISTINCT FROM 'dropped' AND confidence <> 'synthetic' AND list_contains(flags, 'hubzone_set_aside')")
def q_clean_seeds(spark, sf_dir):
    return records(spark, sf_dir).where(C.clean_seed("hubzone_set_aside")).select("pos")


@query("SELECT min(doc_id) AS pos FROM documents GROUP BY text")
def q_dedup_first(spark, sf_dir):
    return C.dedup_first(documents(spark, sf_dir).select(F.col("doc_id").alias("pos"), "text"), "text").select("pos")


@query(f"WITH {RECORDS_SQL} SELECT flag, count(*) AS n FROM (SELECT unnest(CASE WHEN len(flags) > 0 THEN flags ELSE ['no_flag'] END) AS flag FROM records) GROUP BY flag")
def q_flag_histogram(spark, sf_dir):
    return M.flag_histogram(records(spark, sf_dir))


@query(f"""
        WITH {RECORDS_SQL}, n AS (SELECT flag, count(*) AS n FROM (SELECT unnest(flags) AS flag FROM records) GROUP BY flag)
        SELECT v.flag, CAST(coalesce(n, 0) AS BIGINT) AS n, CAST(2 * coalesce(n, 0) AS BIGINT) AS target FROM (SELECT unnest({VOCABULARY_SQL}) AS flag) v LEFT JOIN n USING (flag) WHERE coalesce(n, 0) < 150
    """)
def q_rare_flags(spark, sf_dir):
    return C.rare_flags(records(spark, sf_dir), Taxonomy().table(spark), 150)


@query(f"""
        WITH {RECORDS_SQL}, n AS (SELECT count(*) AS total, count(*) FILTER (validation = 'keep') AS n_keep, count(*) FILTER (validation = 'fixed') AS n_fixed, count(*) FILTER (validation = 'dropped') AS n_dropped FROM records)
        SELECT *, n_keep / CAST(total AS DOUBLE) AS share_keep, n_fixed / CAST(total AS DOUBLE) AS share_fixed, n_dropped / CAST(total AS DOUBLE) AS share_dropped FROM n
    """)
def q_verdict_stats(spark, sf_dir):
    return M.verdict_stats(records(spark, sf_dir))


_RESULTS_SQL = f"""results AS (SELECT doc_id, {lexicon_sql("text", LEXICON)} AS truth, {lexicon_sql("text", WEAK_LEXICON)} AS pred FROM documents)"""


def results(spark, sf_dir, weak=True):
    vocabulary = literals(VOCABULARY)
    raw = documents(spark, sf_dir).select("doc_id", lexicon_answer(F.col("text"), WEAK_LEXICON if weak else LEXICON).alias("raw"), lexicon_flags(F.col("text"), LEXICON).alias("ground_truth"))
    return raw.select("doc_id", P.parse_flags(F.col("raw"), vocabulary).alias("predicted"), "ground_truth", P.format_ok(F.col("raw"), vocabulary).alias("format_ok"))


@query(f"""
        WITH {_RESULTS_SQL}, d AS (SELECT list_filter(pred, lambda f: NOT list_contains(truth, f)) AS more, list_filter(truth, lambda f: NOT list_contains(pred, f)) AS less FROM results WHERE pred <> truth),
        x AS (SELECT unnest(more) AS flag, 1 AS a, 0 AS r FROM d UNION ALL SELECT unnest(less), 0, 1 FROM d)
        SELECT flag, CAST(sum(a) AS BIGINT) AS added, CAST(sum(r) AS BIGINT) AS removed FROM x GROUP BY flag
    """)
def q_flag_diff(spark, sf_dir):
    own = results(spark, sf_dir)
    changed = own.select(F.col("predicted").alias("flags"), F.col("ground_truth").alias("original_flags"), F.when(F.col("predicted") == F.col("ground_truth"), "keep").otherwise("fixed").alias("validation"))
    return M.flag_diff(changed)


_MICRO_SQL = """
            SELECT n_results, n_predicted, n_truth, n_correct, n_format_ok, p AS "precision", r AS recall, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1, n_format_ok / CAST(n_results AS DOUBLE) AS format_compliance
            FROM (SELECT *, n_correct / CAST(n_predicted AS DOUBLE) AS p, n_correct / CAST(n_truth AS DOUBLE) AS r FROM (
                SELECT count(*) AS n_results, CAST(sum(len({pred})) AS BIGINT) AS n_predicted, CAST(sum(len(truth)) AS BIGINT) AS n_truth, CAST(sum(len(list_filter({pred}, lambda f: list_contains(truth, f)))) AS BIGINT) AS n_correct, count(*) AS n_format_ok FROM results))"""


@query(f"WITH {_RESULTS_SQL} {_MICRO_SQL.format(pred='pred')}")
def q_micro_metrics(spark, sf_dir):
    return M.micro_metrics(results(spark, sf_dir))


@query(f"""
        WITH {_RESULTS_SQL}, x AS (
            SELECT unnest(list_filter(pred, lambda f: list_contains(truth, f))) AS flag, 1 AS tp, 0 AS fp, 0 AS fn FROM results
            UNION ALL SELECT unnest(list_filter(pred, lambda f: NOT list_contains(truth, f))), 0, 1, 0 FROM results
            UNION ALL SELECT unnest(list_filter(truth, lambda f: NOT list_contains(pred, f))), 0, 0, 1 FROM results
        ), n AS (SELECT flag, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn FROM x GROUP BY flag)
        SELECT *, CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE 0 END AS "precision", CASE WHEN tp + fn > 0 THEN tp / CAST(tp + fn AS DOUBLE) ELSE 0 END AS recall FROM n
    """)
def q_per_flag_metrics(spark, sf_dir):
    return M.per_flag_metrics(results(spark, sf_dir))


@query(f"""
        WITH {_RESULTS_SQL}, n AS (SELECT count(*) AS total, count(*) FILTER (len(pred) = 0) AS correct FROM results WHERE len(truth) = 0)
        SELECT total, correct, total - correct AS hallucinated, correct / CAST(total AS DOUBLE) AS accuracy FROM n WHERE total > 0
    """)
def q_noflag_accuracy(spark, sf_dir):
    return M.no_flag_accuracy(results(spark, sf_dir))


@query(f"""
        WITH {_RESULTS_SQL}, a AS ({_MICRO_SQL.format(pred="pred")}), b AS ({_MICRO_SQL.format(pred="truth")}),
        x AS (SELECT unnest(['format_compliance', 'precision', 'recall', 'f1']) AS metric, unnest([a.format_compliance, a."precision", a.recall, a.f1]) AS base, unnest([b.format_compliance, b."precision", b.recall, b.f1]) AS tuned FROM a, b)
        SELECT metric, base, tuned, tuned - base AS delta, CASE WHEN tuned - base > 0 THEN '+' ELSE '' END AS sign FROM x
    """)
def q_model_compare(spark, sf_dir):
    return M.compare_models(M.micro_metrics(results(spark, sf_dir)), M.micro_metrics(results(spark, sf_dir, weak=False)))


_LENGTHS_SQL = f"""
            n AS (SELECT len({WORDS_SQL}) AS n FROM documents), s AS (SELECT list(n ORDER BY n) AS s FROM n),
            stats AS (SELECT CAST(len(s) AS BIGINT) AS "count", s[1] AS "min", s[len(s)] AS "max", list_sum(s) / CAST(len(s) AS DOUBLE) AS mean, (s[(len(s) - 1) // 2 + 1] + s[len(s) // 2 + 1]) / CAST(2 AS DOUBLE) AS median,
                             s[least(CAST(floor(len(s) * 0.95::DOUBLE) AS BIGINT), len(s) - 1) + 1] AS p95, s[least(CAST(floor(len(s) * 0.99::DOUBLE) AS BIGINT), len(s) - 1) + 1] AS p99 FROM s)"""


def _lengths(spark, sf_dir):
    return M.length_stats(documents(spark, sf_dir).select(X.word_count(F.col("text")).cast("bigint").alias("n")))


@query(f"WITH {_LENGTHS_SQL} SELECT * FROM stats")
def q_length_stats(spark, sf_dir):
    return _lengths(spark, sf_dir)


@query(f"WITH {_LENGTHS_SQL} SELECT p95, CASE WHEN p95 <= 1024 THEN '1024' WHEN p95 <= 2048 THEN '2048' ELSE 'warn' END AS advice FROM stats")
def q_length_recommendation(spark, sf_dir):
    return M.length_advice(_lengths(spark, sf_dir))


@query(f"WITH {RECORDS_SQL}, c AS (SELECT list_contains(flags, 'hubzone_set_aside') AS ok FROM records) SELECT count(*) AS cases, count(*) FILTER (ok) AS passed, count(*) FILTER (ok) / CAST(count(*) AS DOUBLE) AS rate FROM c")
def q_smoke_pass_rate(spark, sf_dir):
    return M.pass_rate(records(spark, sf_dir).select(P.render_label(F.col("flags")).alias("raw"), F.lit("hubzone_set_aside").alias("expected")))


# --- quotas, early stop, resume ----------------------------------------------------------------------------------------

_TARGETS = [("click", 3000), ("view", 100), ("signup", 1000), ("purchase", 500), ("error", 5000), ("no_flag", 1)]


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), F.col("user_id").alias("rfp_id"), F.col("event_type").alias("flag"))


@query("SELECT t.flag, CAST(coalesce(n, 0) AS BIGINT) AS n, CAST(target AS BIGINT) AS target, coalesce(n, 0) >= target AS filled FROM (VALUES " + ", ".join(f"('{f}', {n})" for f, n in _TARGETS) + ") t(flag, target) LEFT JOIN (SELECT event_type AS flag, count(*) AS n FROM events GROUP BY 1) e USING (flag)")
def q_quota_status(spark, sf_dir):
    return L.quota_status(_events(spark, sf_dir), spark.createDataFrame(_TARGETS, "flag string, target bigint"))


@query("""
        WITH n AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL),
        b AS (SELECT user_id, event_type, coalesce(sum(n) OVER (PARTITION BY event_type ORDER BY user_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM n)
        SELECT e.event_id AS seq, e.user_id AS rfp_id, e.event_type AS flag FROM events e JOIN b USING (user_id, event_type) WHERE before < 500
    """)
def q_quota_gated(spark, sf_dir):
    return L.quota_gated(_events(spark, sf_dir), 500).select("seq", "rfp_id", "flag")


@query("WITH c AS (SELECT event_id AS seq, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM events) SELECT seq FROM c WHERE coalesce(before, 0) < 300")
def q_early_stop(spark, sf_dir):
    return L.stop_after_flagged(_events(spark, sf_dir).withColumn("flagged", F.col("flag") == "purchase"), 300).select("seq")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def q_resume_key(spark, sf_dir):
    return L.not_done(documents(spark, sf_dir), table(spark, sf_dir, "labels"), ["doc_id"]).select("doc_id")


@query("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM documents x WHERE x.doc_id % 2 = 0 AND x.text = d.text)")
def q_resume_text(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return L.not_done_by_text(docs, docs.where("doc_id % 2 = 0")).select("doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id >= 400")
def q_resume_position(spark, sf_dir):
    return L.after_position(documents(spark, sf_dir), 400, "doc_id").select("doc_id")


@query("SELECT event_type AS flag, count(*) AS n FROM events GROUP BY event_type")
def q_stream_quota(spark, sf_dir):
    return event_quotas(spark, sf_dir)


@query("""
        WITH n AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL),
        b AS (SELECT user_id, event_type, coalesce(sum(n) OVER (PARTITION BY event_type ORDER BY user_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM n)
        SELECT e.event_id AS seq, e.user_id AS rfp_id, e.event_type AS flag FROM events e JOIN b USING (user_id, event_type) WHERE before < CASE event_type WHEN 'click' THEN 500 WHEN 'view' THEN 30 WHEN 'error' THEN 1 ELSE 1000000000 END
    """)
def q_stream_gated(spark, sf_dir):
    """q_quota_gated with a target for each flag, as a stream whose state is the quotas."""
    base = f"{shared_dir(spark)}/gated-{uuid.uuid4().hex}"
    events = file_stream(spark, sf_dir, "events.parquet").select(F.col("event_type").alias("flag"), F.col("user_id").alias("rfp_id"), F.col("event_id").alias("seq"))
    write_gated(gate_quotas(events, {"click": 500, "view": 30, "error": 1}), f"{base}/rows", f"{base}/checkpoint")
    return spark.read.schema("flag string, rfp_id bigint, seq bigint").parquet(f"{base}/rows").select("seq", "rfp_id", "flag")


# --- curation ----------------------------------------------------------------------------------------------------------


def _ordered_vocabulary():
    return VOCABULARY


_SEEDS_SQL = f"""
        WITH RECURSIVE {RECORDS_SQL}, x AS (
            SELECT pos, CASE confidence WHEN 'high' THEN 0 WHEN 'synthetic' THEN 2 ELSE 1 END AS rank, unnest(flags) AS flag, unnest(range(0, len(flags))) AS place FROM records WHERE NOT adversarial
        ), c AS (SELECT flag, list(pos ORDER BY rank, pos) AS cands, min(pos * 100 + place) AS first_seen FROM x GROUP BY flag),
        o AS (SELECT *, row_number() OVER (ORDER BY first_seen) AS k FROM c), g AS (
            SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS taken, CAST(NULL AS VARCHAR) AS flag, CAST([] AS BIGINT[]) AS picked
            UNION ALL
            SELECT k, list_concat(taken, picked), flag, picked FROM (SELECT o.k, g.taken, o.flag, list_slice(list_filter(o.cands, lambda p: NOT list_contains(g.taken, p)), 1, 2) AS picked FROM g JOIN o ON o.k = g.k + 1)
        ), seeds AS (SELECT flag, unnest(picked) AS pos FROM g)"""


@query(f"{_SEEDS_SQL} SELECT flag, pos FROM seeds")
def q_seed_select(spark, sf_dir):
    seeds, _ = C.select_seeds(records(spark, sf_dir), 2, _ordered_vocabulary())
    return seeds.select("flag", "pos")


@query(f"{_SEEDS_SQL} SELECT pos FROM records WHERE pos NOT IN (SELECT pos FROM seeds)")
def q_remaining(spark, sf_dir):
    _, left = C.select_seeds(records(spark, sf_dir), 2, _ordered_vocabulary())
    return left.select("pos")


@query(f"""
        WITH {RECORDS_SQL}, cap AS (SELECT CAST(floor(count(*) FILTER (len(flags) > 0) * 0.1::DOUBLE) AS BIGINT) AS cap FROM records),
        neg AS (SELECT pos, row_number() OVER (ORDER BY md5('42|' || pos)) AS n FROM records WHERE len(flags) = 0)
        SELECT pos FROM records WHERE len(flags) > 0 UNION ALL SELECT pos FROM neg, cap WHERE n <= cap
    """)
def q_cap_negatives(spark, sf_dir):
    return C.cap_negatives(records(spark, sf_dir), 0.1).select("pos")


_CAPS = {"small_business_set_aside": 100, "8a_set_aside": 40}


@query(f"""
        WITH {RECORDS_SQL}, f AS (SELECT pos, flag, row_number() OVER (PARTITION BY flag ORDER BY md5('42|' || flag || '|' || pos)) AS n FROM (SELECT pos, unnest(flags) AS flag FROM records)),
        over AS (SELECT pos FROM f WHERE (flag = 'small_business_set_aside' AND n > 100) OR (flag = '8a_set_aside' AND n > 40))
        SELECT pos FROM records WHERE pos NOT IN (SELECT pos FROM over)
    """)
def q_cap_flags(spark, sf_dir):
    return C.cap_flags(records(spark, sf_dir), _CAPS).select("pos")


@query(f"""
        WITH RECURSIVE {RECORDS_SQL}, total AS (
            SELECT list(coalesce(n, 0) ORDER BY i) AS tot FROM (SELECT unnest({VOCABULARY_SQL}) AS flag, unnest(range(0, {len(VOCABULARY)})) AS i) v LEFT JOIN (SELECT flag, count(*) AS n FROM (SELECT unnest(flags) AS flag FROM records) GROUP BY flag) c USING (flag)
        ),
        t AS (SELECT count(*) AS n, CAST(floor(count(*) * 10 / CAST(100 AS DOUBLE)) AS BIGINT) AS e FROM records),
        o AS (
            SELECT pos, f, tot, n, [n - 2 * e, e, e] AS targets, row_number() OVER (ORDER BY coalesce(list_min(list_transform(f, lambda i: tot[i])), 999999), pos) AS k
            FROM (SELECT pos, list_transform(flags, lambda x: list_position({VOCABULARY_SQL}, x)) AS f FROM records), total, t
        ), g AS (
            SELECT CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS pos, 0 AS best, CAST([0, 0, 0] AS BIGINT[]) AS sizes, list_transform(range(0, 21), lambda i: CAST(0 AS BIGINT)) AS counts
            UNION ALL
            SELECT k, pos, best, list_transform([1, 2, 3], lambda s: sizes[s] + CASE WHEN s = best THEN 1 ELSE 0 END), list_transform(range(0, 21), lambda i: counts[i + 1] + CASE WHEN i // 7 + 1 = best AND list_contains(f, i % 7 + 1) THEN 1 ELSE 0 END)
            FROM (SELECT *, CAST(CASE WHEN list_max(scores) IS NULL THEN list_position(room, list_max(room)) ELSE list_position(scores, list_min(scores)) END AS INTEGER) AS best FROM (
                SELECT o.k, o.pos, o.f, g.sizes, g.counts, list_transform([1, 2, 3], lambda s: o.targets[s] - g.sizes[s]) AS room,
                       list_transform([1, 2, 3], lambda s: CASE WHEN len(o.f) > 0 AND g.sizes[s] < o.targets[s] THEN list_max(list_transform(o.f, lambda i: g.counts[(s - 1) * 7 + i] / greatest(CAST(o.tot[i] * o.targets[s] AS DOUBLE) / o.n, 1))) END) AS scores
                FROM g JOIN o ON o.k = g.k + 1))
        ) SELECT pos, ['train', 'eval', 'test'][best] AS split FROM g WHERE k > 0
    """)
def q_stratified_split(spark, sf_dir):
    return C.split_exact(records(spark, sf_dir), "80/10/10")


@query(f"""
        WITH {RECORDS_SQL}, n AS (SELECT flag, count(*) AS n FROM (SELECT unnest(flags) AS flag FROM records) GROUP BY flag),
        s AS (SELECT r.pos, coalesce((SELECT n.flag FROM n WHERE list_contains(r.flags, n.flag) ORDER BY n.n, n.flag LIMIT 1), 'no_flag') AS stratum, CAST('0x' || substr(md5('42|' || r.pos), 1, 6) AS BIGINT) % 100 AS u FROM records r)
        SELECT pos, stratum, CASE WHEN u < 80 THEN 'train' WHEN u < 90 THEN 'eval' ELSE 'test' END AS split FROM s
    """)
def q_split_by_stratum(spark, sf_dir):
    return C.split_by_stratum(records(spark, sf_dir), "80/10/10")


@query("SELECT doc_id AS pos FROM documents ORDER BY md5('7|' || doc_id) LIMIT 100")
def q_sample(spark, sf_dir):
    from tamis.operators.sampling import sample_exactly

    return sample_exactly(documents(spark, sf_dir).select(F.col("doc_id").alias("pos")), 100, 7, "pos")


_SIGNAL_TEXT = {0: "$ 1,200.50 ", 1: "12 FTE on site ", 2: "staff of about 40 ", 3: "place of performance "}


def _signal_texts(spark, sf_dir):
    """Texts with phrases that the signals look for, every fifth without."""
    k = F.col("doc_id") % 5
    phrase = F.coalesce(*(F.when(k == n, F.lit(t)) for n, t in _SIGNAL_TEXT.items()), F.lit(""))
    return documents(spark, sf_dir).select("doc_id", "n_chars", F.concat(phrase, "text").alias("text"))


_SIGNALS_SQL = "signals AS (SELECT doc_id, n_chars, CASE doc_id % 5 " + " ".join(f"WHEN {k} THEN '{t}'" for k, t in _SIGNAL_TEXT.items()) + " ELSE '' END || text AS text FROM documents)"
_ONSITE_SQL = "(" + " OR ".join(f"contains(lower(text), '{t}')" for t in X.ONSITE_TERMS) + ")"
_HEADCOUNT_SQL = "regexp_matches(text, '" + X.HEADCOUNT + "')"
_DOLLAR_SQL = "regexp_matches(text, '" + X.DOLLAR_AMOUNT + "')"
_ROLES_SQL = "len(list_filter(string_split(lower(text), chr(10)), lambda l: " + " OR ".join(f"contains(l, '{k}')" for k in X.ROLE_KEYWORDS) + "))"


@query(f"WITH {_SIGNALS_SQL} SELECT doc_id, {_DOLLAR_SQL} AS hit FROM signals")
def q_dollar(spark, sf_dir):
    return _signal_texts(spark, sf_dir).select("doc_id", X.has_dollar_amount(F.col("text")).alias("hit"))


@query(f"WITH {_SIGNALS_SQL} SELECT doc_id, {_HEADCOUNT_SQL} AS hit FROM signals")
def q_headcount(spark, sf_dir):
    return _signal_texts(spark, sf_dir).select("doc_id", X.has_headcount(F.col("text")).alias("hit"))


@query(f"WITH {_SIGNALS_SQL} SELECT doc_id, {_ONSITE_SQL} AS hit FROM signals")
def q_onsite(spark, sf_dir):
    return _signal_texts(spark, sf_dir).select("doc_id", X.has_onsite_term(F.col("text")).alias("hit"))


@query(f"WITH {_SIGNALS_SQL} SELECT doc_id, CAST({_ROLES_SQL} AS INTEGER) AS n_lines, {_ROLES_SQL} >= 10 AS hit FROM signals")
def q_roles(spark, sf_dir):
    return _signal_texts(spark, sf_dir).select("doc_id", X.role_lines(F.col("text")).alias("n_lines"), X.has_enumerated_roles(F.col("text")).alias("hit"))


@query(f"""
        WITH {_SIGNALS_SQL}, r AS (SELECT doc_id, n_chars % 2 = 0 AS synthetic, {_DOLLAR_SQL} AS dollar, {_HEADCOUNT_SQL} OR {_ROLES_SQL} >= 10 AS team, {_ONSITE_SQL} AS onsite FROM signals)
        SELECT doc_id AS pos, array_to_string(list_filter([CASE WHEN NOT synthetic AND dollar THEN 'budget_too_low' END, CASE WHEN team THEN 'large_team' END, CASE WHEN onsite THEN 'onsite_required' END, 'other'], lambda f: f IS NOT NULL), ',') AS flags,
               true AS removed_brownfield, synthetic OR NOT dollar AS removed_budget, NOT team AS removed_team, NOT onsite AS removed_onsite FROM r
    """)
def q_clean_flags(spark, sf_dir):
    own = _signal_texts(spark, sf_dir).select(F.col("doc_id").alias("pos"), F.col("text").alias("chunk_text"), literals(["brownfield", "budget_too_low", "large_team", "onsite_required", "other"]).alias("flags"), F.when(F.col("n_chars") % 2 == 0, "synthetic").otherwise("high").alias("confidence"))
    return C.clean_flags(own).select("pos", joined("flags"), "removed_brownfield", "removed_budget", "removed_team", "removed_onsite")


_CORRECTED = ["agile_methodology", "made_up"]


@query(f"""
        WITH {RECORDS_SQL}, v AS (SELECT *, CASE WHEN pos % 7 = 0 THEN 'FIX' WHEN pos % 7 = 1 THEN 'DROP' WHEN pos % 7 = 2 THEN 'KEEP' END AS v FROM records)
        SELECT pos, CASE WHEN v = 'FIX' THEN 'agile_methodology' ELSE array_to_string(flags, ',') END AS flags, CASE v WHEN 'FIX' THEN 'fixed' WHEN 'DROP' THEN 'dropped' ELSE 'keep' END AS validation, array_to_string(flags, ',') AS original_flags, CASE WHEN v = 'DROP' THEN 'off topic' END AS drop_reason FROM v
    """)
def q_apply_verdicts(spark, sf_dir):
    own = records(spark, sf_dir)
    k = F.col("pos") % 7
    first = own.where("pos % 7 < 3").select(F.floor(F.col("pos") / 10).cast("bigint").alias("batch_id"), (F.col("pos") % 10).cast("int").alias("index"), F.lit(0).alias("seq"), F.lit("drop").alias("verdict"), literals([]).alias("corrected_flags"), F.lit("").alias("reason"))
    last = own.where("pos % 7 < 3").select(F.floor(F.col("pos") / 10).cast("bigint").alias("batch_id"), (F.col("pos") % 10).cast("int").alias("index"), F.lit(1).alias("seq"), F.when(k == 0, "fix").when(k == 1, "DROP").otherwise("Keep").alias("verdict"), literals(_CORRECTED).alias("corrected_flags"), F.lit("off topic").alias("reason"))
    done = L.apply_verdicts(own, first.unionByName(last), literals(VOCABULARY))
    return done.select("pos", joined("flags"), "validation", joined("original_flags"), "drop_reason")


@query(f"""
        WITH {RECORDS_SQL}, a AS (SELECT pos, flags, CASE WHEN pos % 2 = 0 THEN flags ELSE list_filter(flags, lambda f: f <> 'small_business_set_aside') END AS new FROM records)
        SELECT pos, array_to_string(new, ',') AS flags, CASE WHEN len(flags) = 0 THEN 'skip' WHEN len(new) = len(flags) THEN 'keep' ELSE 'fixed' END AS validation, CASE WHEN len(new) <> len(flags) THEN array_to_string(flags, ',') END AS original_flags FROM a
    """)
def q_revalidate(spark, sf_dir):
    own = records(spark, sf_dir)
    answers = own.select("pos", F.when(F.col("pos") % 2 == 0, F.reverse("flags")).otherwise(F.concat(F.filter("flags", lambda f: f != "small_business_set_aside"), F.array(F.lit("made_up")))).alias("answered"))
    return L.revalidate(own, answers, literals(VOCABULARY), ["pos"]).select("pos", joined("flags"), "validation", joined("original_flags"))


# --- retrieval ---------------------------------------------------------------------------------------------------------

_PAIRS_SQL = """
        v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
        n AS (SELECT vec_id, label, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM v),
        d AS (SELECT q.vec_id AS query_id, c.vec_id AS id, 1 - list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) / (q.norm * c.norm) AS distance FROM n q JOIN n c ON q.vec_id % 100 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(distance, 12), id) AS rank FROM d)"""


def _vectors(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), e.select(F.col("vec_id").alias("id"), "embedding", F.concat(F.lit("passage "), F.col("vec_id").cast("string")).alias("passage"), F.concat(F.lit("flag_"), F.col("label").cast("string")).alias("flag"))


@query(f"WITH {_PAIRS_SQL} SELECT query_id, CAST(rank AS INTEGER) AS rank, id, round(distance, 6) + 0.0 AS distance FROM r WHERE rank <= 3")
def q_vector_topk(spark, sf_dir):
    queries, passages = _vectors(spark, sf_dir)
    return V.top_k(queries, passages, 3).withColumn("distance", F.round("distance", 6) + F.lit(0.0))


@query(f"WITH {_PAIRS_SQL}, o AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS rank FROM r WHERE rank <= 4 AND id <> query_id) SELECT query_id, CAST(rank AS INTEGER) AS rank, id FROM o WHERE rank <= 3")
def q_vector_exclude_self(spark, sf_dir):
    queries, passages = _vectors(spark, sf_dir)
    return V.drop_self(V.top_k(queries, passages, 4), F.col("id") == F.col("query_id"), 3).select("query_id", "rank", "id")


@query("SELECT 'real_flag_' || label || '_' || (row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1) AS id, vec_id AS pos FROM embeddings")
def q_vector_ids(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("pos"), F.concat(F.lit("flag_"), F.col("label").cast("string")).alias("flag"))
    return V.passage_ids(e, prefix="real_").select("id", "pos")


@query("SELECT 'flag_' || label || '_' || n AS id, vec_id AS pos FROM (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS n FROM embeddings) WHERE n >= 10")
def q_vector_add(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("pos"), F.concat(F.lit("flag_"), F.col("label").cast("string")).alias("flag"))
    stored = V.passage_ids(e).where(F.substring_index("id", "_", -1).cast("int") < 10)
    return V.new_passages(e, stored).select("id", "pos")


@query(f"""
        WITH {_PAIRS_SQL}, h AS (SELECT query_id, list('passage ' || id ORDER BY rank) AS p FROM r WHERE rank <= 3 GROUP BY query_id),
        c AS (SELECT vec_id AS query_id, 'chunk ' || vec_id AS chunk FROM embeddings)
        SELECT query_id, CASE WHEN p IS NULL THEN chunk ELSE '[Retrieved context]' || chr(10) || chr(10) || 'Example 1:' || chr(10) || p[1] || chr(10) || chr(10) || 'Example 2:' || chr(10) || p[2] || chr(10) || chr(10) || 'Example 3:' || chr(10) || p[3] || chr(10) || chr(10) || '---' || chr(10) || chr(10) || 'RFP chunk to analyze:' || chr(10) || chunk END AS content
        FROM c LEFT JOIN h USING (query_id)
    """)
def q_rewrap(spark, sf_dir):
    queries, passages = _vectors(spark, sf_dir)
    chats = passages.select(F.col("id").alias("query_id"), R.chat_record(R.context_block(literals(["old"]), F.concat(F.lit("chunk "), F.col("id").cast("string"))), literals([])).alias("messages"))
    wrapped = V.wrap(V.unwrap_chat(chats), V.gather_hits(V.top_k(queries, passages, 3), passages))
    return wrapped.select("query_id", R.first_content(V.rewrap_chat(F.col("messages"), F.col("wrapped")), "user").alias("content"))


# --- packages ----------------------------------------------------------------------------------------------------------


@query("""
        WITH m AS (SELECT 'p' || (doc_id // 3) AS package, doc_id, source, text, row_number() OVER (PARTITION BY doc_id // 3 ORDER BY doc_id) AS i, count(*) OVER (PARTITION BY doc_id // 3) AS n FROM documents),
        s AS (SELECT package, n, list(CASE WHEN n = 1 THEN text ELSE repeat('=', 40) || chr(10) || 'DOCUMENT ' || i || ' of ' || n || ': ' || source || chr(10) || repeat('=', 40) || chr(10) || chr(10) || text END ORDER BY i) AS l FROM m GROUP BY package, n)
        SELECT package, md5(CASE WHEN n = 1 THEN l[1] ELSE 'MULTI-DOCUMENT PACKAGE (' || n || ' documents)' || chr(10) || chr(10) || array_to_string(l, chr(10) || chr(10)) END) AS text_md5 FROM s
    """)
def q_package_combine(spark, sf_dir):
    docs = documents(spark, sf_dir).withColumn("package", F.concat(F.lit("p"), F.floor(F.col("doc_id") / 3).cast("string")))
    return combine_packages(docs, "package", "doc_id", "source", "text").select("package", F.md5("text").alias("text_md5"))
