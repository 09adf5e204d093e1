"""The registered queries of this package: name -> (spark, sf_dir) -> DataFrame, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.functions.text import let
from tamis.llm.topk_search import topk_search
from tamis.llm.embedding_dedup import embedding_near_duplicates
from tamis.llm.secrets import scan_secrets
from tamis.llm.line_dedup import drop_boilerplate
from tamis.llm.language_id import identify_languages
from tamis.llm.byte_bpe import encode_documents
from tamis.llm.mixing import mix_sources
from tamis.llm.quality import score_quality
from tamis.llm.url_filter import filter_urls, host_of
from tamis.llm.jaccard_join import jaccard_components
from tamis.llm.sharding import shard_records
from tamis.llm.clustering import cluster_vectors
from tamis.llm.merkle import merkle_manifest, siblings
from tamis.shipping import ship


SHARDS, CENTROIDS, ROUNDS = 8, 16, 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk_search(vectors, vectors.where("vec_id % 50 = 0"), k=5, scale=256.0)


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


def tokenizer(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """Path of a rank file and the pattern that splits text before its merges."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"), *tokenizer())


#: What of a page is not shown, and the tags that end a line. A pattern that begins with one character looks for the rest only where that stands; white space, ends of words and the long s are what they are in SQL.
_HIDDEN = r"(?is)<(?:[sſ]cript(?!\w).*?</[sſ]cript[\t\n\f\r ]*>|[sſ]tyle(?!\w).*?</[sſ]tyle[\t\n\f\r ]*>|head(?!\w).*?</head[\t\n\f\r ]*>|!--.*?-->)"
_LINE_ENDS = r"(?i)</?(?:p|br|li|ul|ol|div|nav|article|[sſ]ection|header|footer|table|tr|h[1-6])(?!\w)[^>]*>"
_TAGS = r"<[^>]*>"


def visible_lines(html: Column) -> Column:
    """The text of a page, a line for each block that is not blank. A line loses white space before it (the first one: none) and blanks after it (the last one: none)."""
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(html, _HIDDEN, ""), _LINE_ENDS, "\n"), _TAGS, "")

    def shown(lines: Column) -> Column:
        begun = lambda x, i: F.when(i > 0, F.ltrim(x, F.lit("\t\n\f\r "))).otherwise(x)
        ended = lambda x, i: F.when(i < F.size(lines) - 1, F.rtrim(x, F.lit("\t\r "))).otherwise(x)
        return F.array_join(F.filter(F.transform(lines, lambda x, i: ended(begun(x, i), i)), lambda x: x != ""), "\n")

    return let(F.split(text, "\n", -1), shown)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", host_of(F.col("url")).alias("host"), visible_lines(F.col("html")).alias("text"))
    return drop_boilerplate(pages, host_col="host")


def held_out() -> Column:
    """Rows that no model learns from."""
    return F.coalesce(F.expr("crc32(cast(doc_id AS string)) % 3 = 1"), F.lit(False))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify_languages(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), *tokenizer(), digests=True)


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), keep=["doc_id"]).drop("copies")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    scored = score_quality(documents, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """The dated list that op10 applies: by a rule over the hosts of the pages (a number k from length and first letter), adds, removals and additions again of hosts, and one path prefix for each registered domain."""
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host IS NOT NULL").distinct()
    k = (F.length("host") * 7 + F.ascii("host")) % 10
    day = lambda n: F.timestamp_seconds(F.lit(1704067200) + F.lit(86400) * n)
    entry = lambda domain, prefix, action, at: F.struct(domain.alias("domain"), F.lit(prefix).alias("prefix"), F.lit(action).alias("action"), at.alias("listed_at"))
    host, n = F.col("host"), F.col("k") * 31
    own = hosts.withColumn("k", k).where("k < 4").select(F.inline(F.array(entry(host, "/", "add", day(n)), entry(host, "/", "remove", day(n + 120)), entry(host, "/", "add", day(n + 300)))))
    top = hosts.select(F.substring_index("host", ".", -2).alias("host")).distinct()
    return own.unionByName(top.select(F.inline(F.array(entry(host, "/de/", "add", day(F.lit(60))), entry(host, "/de/", "remove", day(F.lit(400)))))))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_at", F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.col("page_id") * 79193, F.lit(63072000))))
    found = filter_urls(captures, dated_entries(pages))
    return found.withColumn("fetched_at", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), percent=80, width=5)


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_records(table(spark, sf_dir, "documents"), weights=[1.0] * SHARDS)


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"), k=CENTROIDS, rounds=ROUNDS)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    text = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    made = merkle_manifest(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], group_col="source", order_col="doc_id", changed={"text": text})
    proof = F.sha2(siblings(F.col("path")), 256).alias("proof_sha256")
    return made.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk_search": op1_topk_search,
    "op2_embedding_near_dedup": op2_embedding_near_dedup,
    "op3_secret_scan": op3_secret_scan,
    "op4_line_dedup": op4_line_dedup,
    "op7_language_id": op7_language_id,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_source_mixing": op9_source_mixing,
    "op6_quality": op6_quality,
    "op10_url_filter": op10_url_filter,
    "op5_jaccard_join": op5_jaccard_join,
    "op11_sharding": op11_sharding,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_merkle_manifest": op13_merkle_manifest,
}

#: The table of the CRC-32 of the reflected polynomial 0xEDB88320, by its rule, and the checksum of a list of bytes.
_CRC_TABLE = "tab AS (SELECT list_transform(range(0, 256), lambda i: list_reduce(list_concat([i], range(0, 8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"


def _crc(text: str) -> str:
    bytes_ = f"list_transform(regexp_extract_all(hex({text}), '..'), lambda x: CAST('0x' || x AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295], {bytes_}), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"


def _rounds_sql(k: int, rounds: int) -> str:
    """CTEs c0, a0, c1, ...: centroids before a round, and key = k * distance + cluster of each vector."""
    pair = "CAST(list_sum(list_transform(list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)"
    out = [f"c0 AS (SELECT CAST(n AS BIGINT) AS c, v FROM (SELECT v, row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1 AS n FROM x) WHERE n < {k})"]
    for r in range(rounds + 1):
        out.append(f"a{r} AS (SELECT x.r, min({k} * {pair} + c.c) AS key FROM x, c{r} c GROUP BY x.r)")
        if r < rounds:
            out.append(f"s{r} AS (SELECT key % {k} AS c, j, sum(v[j]) AS s, count(*) AS n FROM a{r} JOIN x USING (r), range(1, 65) t(j) GROUP BY 1, 2)")
            out.append(f"m{r} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS v FROM s{r} GROUP BY c)")
            out.append(f"c{r + 1} AS (SELECT c{r}.c, coalesce(m{r}.v, c{r}.v) AS v FROM c{r} LEFT JOIN m{r} ON c{r}.c = m{r}.c)")
    return ", ".join(out)


def _leaf_sql(text: str) -> str:
    frame = lambda x: f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen(CAST({x} AS VARCHAR)) || ':' || {x} END"
    return "sha256(" + " || ".join(frame(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"

ORACLES: dict[str, str] = {
    "op1_topk_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        ), r AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n, vec_id, score FROM s
        )
        SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
    """,
    "op2_embedding_near_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), n AS (
            SELECT vec_id, label, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM v
        ), link AS (
            SELECT a.vec_id AS a, b.vec_id AS b
            FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) / (a.norm * b.norm) >= 0.98
        ), reach AS (
            SELECT vec_id AS a, vec_id AS b FROM embeddings
            UNION
            SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
        ), c AS (
            SELECT a, min(b) AS component_id FROM reach GROUP BY a
        )
        SELECT c.a AS vec_id, CAST((SELECT count(*) FROM link WHERE link.a = c.a) AS BIGINT) AS n_links, component_id, c.a = component_id AS kept FROM c
    """,
    "op4_line_dedup": r"""
        WITH shown AS (
            SELECT page_id, nullif(rtrim(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)', 1)), '.'), '') AS host,
                   regexp_replace(regexp_replace(regexp_replace(html, '<script\b.*?</script\s*>|<style\b.*?</style\s*>|<head\b.*?</head\s*>|<!--.*?-->', '', 'gis'), '</?(p|br|li|ul|ol|div|nav|article|section|header|footer|table|tr|h[1-6])\b[^>]*>', chr(10), 'gi'), '<[^>]*>', '', 'g') AS t
            FROM pages
        ), pages_ AS (
            SELECT page_id, host, regexp_replace(regexp_replace(t, '[ \t\r]*\n\s*', chr(10), 'g'), '^\n|\n$', '', 'g') AS text FROM shown
        ), lines AS (
            SELECT page_id, host, unnest(string_split(text, chr(10))) AS line FROM pages_
        ), often AS (
            SELECT host, line, count(DISTINCT page_id) AS n FROM lines WHERE line <> '' GROUP BY ALL
        ), total AS (
            SELECT host, count(*) AS pages FROM pages_ GROUP BY host
        ), gone AS (
            SELECT o.host, list(o.line) AS drop_lines
            FROM often o JOIN total t ON o.host IS NOT DISTINCT FROM t.host
            WHERE o.n >= 3 AND o.n > 0.08::DOUBLE * t.pages
            GROUP BY o.host
        ), met AS (
            SELECT d.page_id, d.host, d.text, string_split(d.text, chr(10)) AS l,
                   list_filter(string_split(d.text, chr(10)), lambda x: NOT coalesce(list_contains(g.drop_lines, x), false)) AS k
            FROM pages_ d LEFT JOIN gone g ON d.host IS NOT DISTINCT FROM g.host
        )
        SELECT page_id, host, CASE WHEN text IS NULL THEN NULL ELSE coalesce(array_to_string(k, chr(10)), '') END AS text,
               CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(l) - len(k), 0) AS BIGINT) AS n_dropped
        FROM met
    """,
    "op10_url_filter": """
        WITH p AS (
            SELECT page_id, nullif(rtrim(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)', 1)), '.'), '') AS host,
                   regexp_replace(regexp_replace(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*', ''), '[?#].*$', '') AS path,
                   TIMESTAMP '2024-01-01 00:00:00' + to_seconds((page_id * 79193) % 63072000) AS fetched_at
            FROM pages
        ), h AS (
            SELECT DISTINCT host, (length(host) * 7 + ascii(host)) % 10 AS k FROM p WHERE host IS NOT NULL
        ), t AS (
            SELECT DISTINCT array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS host FROM h
        ), e AS (
            SELECT host AS domain, '/' AS prefix, 'add' AS action, k * 31 AS d FROM h WHERE k < 4
            UNION ALL SELECT host, '/', 'remove', k * 31 + 120 FROM h WHERE k < 4
            UNION ALL SELECT host, '/', 'add', k * 31 + 300 FROM h WHERE k < 4
            UNION ALL SELECT host, '/de/', 'add', 60 FROM t
            UNION ALL SELECT host, '/de/', 'remove', 400 FROM t
        ), o AS (
            SELECT domain, prefix, d, max(action) AS action FROM e GROUP BY ALL
        ), i AS (
            SELECT domain || prefix AS rule, domain, prefix, action, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(d AS INTEGER)) AS valid_from,
                   coalesce(TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(lead(d) OVER (PARTITION BY domain, prefix ORDER BY d) AS INTEGER)), TIMESTAMP '9999-12-31 00:00:00') AS valid_to
            FROM o
        ), m AS (
            SELECT p.page_id, count(*) AS n, min(rule) AS rule
            FROM p JOIN i ON i.action = 'add' AND (p.host = i.domain OR ends_with(p.host, '.' || i.domain))
                         AND starts_with(CASE WHEN p.path = '' THEN '/' ELSE p.path END, i.prefix) AND i.valid_from <= p.fetched_at AND p.fetched_at < i.valid_to
            GROUP BY p.page_id
        )
        SELECT p.page_id, p.host, strftime(p.fetched_at, '%Y-%m-%d %H:%M:%S') AS fetched_at, m.n IS NOT NULL AS blocked, CAST(coalesce(m.n, 0) AS BIGINT) AS n_rules, m.rule AS first_rule
        FROM p LEFT JOIN m USING (page_id)
    """,
    "op5_jaccard_join": """
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
        ), s AS (
            SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s, len(ws) < 5 AS short FROM w
        ), t AS (
            SELECT doc_id, short, len(s) AS n, unnest(s) AS token FROM s
        ), p AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, min(a.n) AS n, min(b.n) AS m FROM t a JOIN t b ON a.token = b.token AND a.short = b.short AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
        ), link AS (
            SELECT a, b FROM p WHERE 100 * c >= 80 * (n + m - c) UNION ALL SELECT b, a FROM p WHERE 100 * c >= 80 * (n + m - c)
        ), reach AS (
            SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
        )
        SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, (SELECT min(b) FROM reach WHERE reach.a = s.doc_id) AS component_id FROM s
    """,
    "op11_sharding": f"""
        WITH {_CRC_TABLE}, d AS (SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '-') AS k, coalesce(strlen(text), 0) + 1 AS size, {_crc("coalesce(text, '')")} AS crc FROM documents, tab),
        b AS (SELECT *, list_transform(range(0, {SHARDS + 1}), lambda s: -ln((CAST('0x' || substr(md5(k || ':' || s), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE)) AS bids FROM d),
        p AS (SELECT *, list_position(bids[1:{SHARDS}], list_min(bids[1:{SHARDS}])) - 1 AS shard, list_position(bids, list_min(bids)) - 1 AS grown FROM b)
        SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard, CAST(row_number() OVER (PARTITION BY shard ORDER BY md5(k || ':' || size || ':' || crc), doc_id, size, crc) - 1 AS BIGINT) AS slot, CAST(grown AS INTEGER) AS grown_shard FROM p
    """,
    "op12_centroid_clustering": f"""
        WITH x AS (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), {_rounds_sql(CENTROIDS, ROUNDS)},
        f AS (SELECT vec_id, key % {CENTROIDS} AS c, key // {CENTROIDS} AS distance FROM a{ROUNDS} JOIN x USING (r))
        SELECT vec_id, CAST(f.c AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance, CAST(sum(distance) OVER (PARTITION BY f.c) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(z.v, ',')) AS centroid_sha256
        FROM f JOIN c{ROUNDS} z ON f.c = z.c
    """,
    "op13_merkle_manifest": f"""
        WITH RECURSIVE {_CRC_TABLE}, d AS (
            SELECT doc_id, source, {_leaf_sql("text")} AS leaf, CASE WHEN doc_id IS NOT NULL AND {_crc("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} END AS other FROM documents, tab
        ), l AS (
            SELECT row_number() OVER () AS r, doc_id, source, leaf, coalesce(other, leaf) AS now, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM d
        ), up AS (
            SELECT 0 AS lvl, source, pos, leaf AS digest, n FROM l
            UNION ALL
            SELECT lvl + 1, source, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (min(n) + 2) // 3 FROM up WHERE n > 1 GROUP BY lvl, source, pos // 3
        ), sub AS (
            SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1
        ), top AS (
            SELECT 0 AS lvl, pos, subroot AS digest, n FROM sub
            UNION ALL
            SELECT lvl + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (min(n) + 2) // 3 FROM top WHERE n > 1 GROUP BY lvl, pos // 3
        ), beside AS (
            SELECT FALSE AS is_top, lvl, source, pos, coalesce(string_agg(digest, '') OVER (a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before, coalesce(string_agg(digest, '') OVER (a ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
            FROM up WHERE n > 1 WINDOW a AS (PARTITION BY lvl, source, pos // 3 ORDER BY pos)
        ), above AS (
            SELECT lvl, pos, coalesce(string_agg(digest, '') OVER (a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before, coalesce(string_agg(digest, '') OVER (a ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
            FROM top WHERE n > 1 WINDOW a AS (PARTITION BY lvl, pos // 3 ORDER BY pos)
        ), walk AS (
            SELECT r, source, 0 AS lvl, pos, now AS acc, '' AS sib, n FROM l
            UNION ALL
            SELECT w.r, w.source, w.lvl + 1, w.pos // 3, sha256(b.before || w.acc || b.after), w.sib || b.before || b.after, (w.n + 2) // 3
            FROM walk w JOIN beside b ON w.n > 1 AND b.lvl = w.lvl AND b.pos = w.pos AND b.source IS NOT DISTINCT FROM w.source
        ), climb AS (
            SELECT w.r, 0 AS lvl, s.pos, w.acc, w.sib, s.n, s.subroot FROM walk w JOIN sub s ON w.n = 1 AND s.source IS NOT DISTINCT FROM w.source
            UNION ALL
            SELECT c.r, c.lvl + 1, c.pos // 3, sha256(a.before || c.acc || a.after), c.sib || a.before || a.after, (c.n + 2) // 3, c.subroot FROM climb c JOIN above a ON c.n > 1 AND a.lvl = c.lvl AND a.pos = c.pos
        )
        SELECT l.doc_id, l.leaf, c.subroot, t.digest AS root, sha256(c.sib) AS proof_sha256, c.acc AS folded_root, c.acc = t.digest AS verified FROM climb c JOIN l USING (r), top t WHERE c.n = 1 AND t.n = 1
    """,
}


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {name: shipped(query) for name, query in _QUERIES.items()}
